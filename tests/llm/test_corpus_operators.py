"""Near duplicates, archives, mixing, line dedup and URL rules against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from feedmill.llm import components, line_dedup, mixing, simhash, spotsigs, url_filter, warc
from feedmill.runtime import new_path

SF = "/root/testdata/sf0.01"


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = groups({x for p in links for x in p}, links)
    assert got == {n: r for n, r in want.items() if n in got} and set(want) - set(got) <= {n for n, r in want.items() if list(want.values()).count(r) == 1}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_simhash(text, size=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_equals_plain_and_spark_hash(spark):
    texts = ["", None, "A b", "É x É y z W\u00a0v", "a b c d e f g", " \x0b a\x0cb\u2028c "]
    for t in texts + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]:
        assert simhash.simhash64(t) & (2**64 - 1) == plain_simhash(t)
    one = spark.sql("select xxhash64('a b c d') h").first().h & (2**64 - 1)
    assert one == xxhash.xxh64_intdigest("a b c d", 42)


def test_links_span_every_group(spark):
    rnd = random.Random(2)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:80]:
        for _ in range(5):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    base = rnd.getrandbits(64)
    fps |= {base ^ (1 << a) ^ (1 << b) for a, b in combinations(range(20), 2)}  # more than SMALL in one bucket
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(r.u, r.v) for r in simhash.fingerprint_links(df).collect()]
    close = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in got)
    assert groups(signed, got) == groups(signed, close)


def test_simhash_groups_over_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    extra = spark.createDataFrame([(9001, None), (9002, ""), (9003, " \n"), (None, "")], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: r for r in simhash.simhash_groups(df.withColumn("fp", F.lit("x"))).collect()}
    ids = [i for i in got if i is not None]
    fp = {i: got[i].fp & (2**64 - 1) for i in ids}
    links = [(a, b) for a, b in combinations(ids, 2) if (fp[a] ^ fp[b]).bit_count() <= 4]
    assert {i: got[i].component_id for i in ids} == groups(ids, links)
    assert got[None].component_id == 9001
    kept = simhash.keep_one(df.withColumns({"_keep": F.lit(1), "fp": F.lit(2), "component_id": F.lit(3)}))
    assert {r.doc_id for r in kept.collect()} == {i for i in ids if got[i].component_id == i}
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def spot_set(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    stop, out = set(spotsigs.ANCHORS), set()
    for i, w in enumerate(words):
        if w not in stop:
            continue
        content = [x for x in words[i + 1 :] if x not in stop][: spotsigs.CHAIN]
        if len(content) == spotsigs.CHAIN:
            out.add((w, *content))
    return out


def test_spots(spark):
    run = " ".join(["the", "of", "and"] * 7)  # longer than any fixed number of skipped words
    texts = [
        "The cat of the mat and the dog. THE!! cat&&& of the", "of a cat in hat", "none here", "", None, "the " * 18 + "cat dog", "the " * 40, f"x {run} cat {run} dog {run}", f"{run} É{run}é ünd {run} der 9 a b",
        "the " * 40 + "cat " + "of " * 17 + "mat",
    ]
    sets = [spot_set(t) for t in texts]
    alone = sorted(set().union(*sets))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, " ".join(x)) for i, x in enumerate(alone)], "doc_id long, text string")
    sigs = {r.doc_id: r.s for r in spotsigs.with_signature(df, "text", "s").select("doc_id", "s").collect()}
    one = {x: sigs[100 + i] for i, x in enumerate(alone)}
    assert all(len(h) == 1 for h in one.values()) and len({h[0] for h in one.values()}) == len(alone)
    for i, want in enumerate(sets):
        if want:
            assert sigs[i] == sorted(one[x][0] for x in want), texts[i]
        else:
            assert len(sigs[i]) == bool((texts[i] or "").strip())


def test_edited_likeness(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()} | {5000: "For " * 3000, 5001: "", 5002: None, 5003: "😀é" * 9}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    ids = sorted(texts)
    rows = {r.doc_id: r for r in spotsigs.edited_likeness(df).collect()}
    assert sorted(rows) == ids
    for i, d in enumerate(ids):
        own, nxt = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        k = len(own) // 2
        edited = own[: len(own) - k] + nxt[:k]
        r = rows[d]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [set(re.findall("........", x)) for x in (r.fingerprint, r.edited_fingerprint)]
        union = len(sets[0] | sets[1])
        assert r.near_edited == pytest.approx(len(sets[0] & sets[1]) / union if union else 1.0)
    same = defaultdict(set)
    for d in ids:
        same[texts[d] or ""].add(rows[d].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_likeness_of_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "of a b"), (1, "of a b"), (2, "of c d"), (2, "of b d"), (None, "of z z")], "doc_id long, text string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((repr(r.doc_id), r.edited_sha256) for r in spotsigs.edited_likeness(df).collect())
    # after 1 comes 2 with the text that sorts first, after 2 the row without an id, after it 1
    want = [("1", digest("of " + "of ")), ("1", digest("of " + "of ")), ("2", digest("of " + "of ")), ("2", digest("of " + "of ")), ("None", digest("of " + "of "))]
    assert got == sorted(want)
    odd = spark.createDataFrame([(1, "abcdef"), (1, "abcdxx"), (2, "zz"), (2, "yyyyyyy"), (None, "QRSTUV"), (None, "MNOP"), (3, None)], "doc_id long, text string")
    got = sorted((repr(r.doc_id), r.n_chars, r.edited_sha256) for r in spotsigs.edited_likeness(odd).collect())
    want = [("1", 6, "abcyyy"), ("1", 6, "abcyyy"), ("2", 2, "z"), ("2", 7, "yyyy"), ("3", 0, ""), ("None", 6, "QRSabc"), ("None", 4, "MNab")]
    assert got == sorted((i, n, digest(t)) for i, n, t in want)
    alone = spark.createDataFrame([(None, "abcd"), (None, "wxyz")], "doc_id long, text string")
    assert {r.edited_sha256 for r in spotsigs.edited_likeness(alone).collect()} == {digest("abab"), digest("wxab")}
    assert spotsigs.edited_likeness(df.limit(0)).count() == 0


def test_spotsig_pairs_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 400")
    members, pairs = spotsigs.near_duplicates(docs, 0.8)
    of = {r.doc_id: r.class_id for r in members.collect()}
    sigs = {r.doc_id: frozenset(r.s) for r in spotsigs.with_signature(docs, "text", "s").collect() if r.s}
    reps = {min(d for d in sigs if sigs[d] == s): s for s in set(sigs.values())}
    want = {(a, b) for a, b in combinations(sorted(reps), 2) if len(reps[a] & reps[b]) >= 0.8 * len(reps[a] | reps[b])}
    assert {(r.class_a, r.class_b) for r in pairs.collect()} == want
    assert all(sigs[d] == sigs[of[d]] for d in sigs)


PAGES = [
    (1, "u", "WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.0\r\n" + "x" * 200), (2, None, None), (3, "a\r\nb", "é" * 50), (4, "u", "é" * 50), (5, "u", "a" * 99), (6, "u", "a" * 99),
    (7, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (None, "u", "é" * 50), (8, "u", "é" * 49), (9, "u", "WARC/1." * 9), (3, "u", "é" * 50),
]


def test_archives_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).coalesce(2)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()))
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        again = body == ("é" * 50).encode() and page != 3
        want.append((page or 0, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=lambda x: x[:4])
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_split_anywhere(spark):
    df = spark.createDataFrame([(i, "u", f"{i} WARC/1.0\r\n" + "y" * (i * 37 % 400)) for i in range(120)], "page_id long, url string, html string").coalesce(1)
    path = new_path(spark)
    warc.write_archives(df, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1777")
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 120 and all(r.payload_sha256 == r.stored_digest and r.payload_length == r.stored_length for r in got)


def test_mix_holds_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    odd = spark.createDataFrame([(9000, None, None), (9001, "a b", None), (9002, "", "zz"), (9003, "q " * 700, "zzz"), (9003, "q " * 700, "zzz")], "doc_id long, text string, source string")
    df = docs.unionByName(odd).withColumn("rank", F.lit(1))
    got = mixing.mix_report(df).collect()
    again = mixing.mix_report(df.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    source = {r.doc_id: r.source for r in df.collect()}
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        size[s] += r["size"]
        target[s] = r.target
        taken[s] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    assert {r.source_size for r in got if source[r.doc_id] == "src0"} == {size["src0"]}
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    open_, want, left = set(order), {}, 1.5 * sum(size.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            break
        for s in over:
            want[s] = 2 * size[s]
            left -= want[s]
        open_ -= over
    want |= {s: weight[s] * level for s in open_}
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(0.03 * want[s], 40)
    assert mixing.mix_report(df.limit(0)).count() == 0


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1023):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    assert [r.p for r in spark.range(50).select(mixing.permuted(F.col("id"), F.lit(50).cast("long"), F.lit(3)).alias("p")).collect()] != list(range(50))


def test_mixed_documents_hold_taken_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).withColumns({"runs": F.lit(1), "pass": F.lit(2), "row": F.lit("r"), "_k": F.lit(0), "size": F.lit(0)})
    report = {r.doc_id: r.taken for r in mixing.mix_report(docs, 64).collect()}
    words = defaultdict(int)
    out = mixing.mixed_documents(docs, 64)
    assert out.columns == docs.columns
    for r in out.collect():
        words[r.doc_id] += len(re.findall("[^\x20\x09-\x0d]+", r.text))
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in report.items() if v} == dict(words)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rnd, text, k, alphabet):
    out = list(text)
    for _ in range(k):
        at, kind = rnd.randrange(len(out) + 1), rnd.randrange(3)
        if kind == 0 or not out or at == len(out):
            out.insert(at, rnd.choice(alphabet))
        elif kind == 1:
            del out[at]
        else:
            out[at] = rnd.choice(alphabet)
    return "".join(out)


def test_banded_distance():
    rnd = random.Random(4)
    for _ in range(6000):
        a = "".join(rnd.choices("abc", k=rnd.randint(0, 14)))
        b = changed(rnd, a, rnd.randint(0, 4), "abc") if rnd.random() < 0.7 else "".join(rnd.choices("abc", k=rnd.randint(0, 14)))
        for k in (1, 2, 3):
            assert line_dedup.within(a, b, k) == (edits(a, b) <= k)
    assert line_dedup.within("x" * 100_000 + "a", "x" * 100_000 + "b", 1)


def test_line_classes_equal_brute_force(spark):
    rnd = random.Random(8)
    base = [" ".join("".join(rnd.choices("abcde", k=rnd.randint(2, 6))) for _ in range(rnd.randint(4, 9))) for _ in range(30)]
    base += ["menu", "one two", "shared stem of the line number 00000000 end"]
    pool = base + [changed(rnd, x, rnd.randint(1, 3), "abcde") for x in base[:30] for _ in range(4)] + [f"shared stem of the line number {i:08d} end" for i in range(0, 90, 7)]
    docs = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(1, 8)))) for i in range(120)] + [(500, None), (501, ""), (502, "  \n\n"), (None, base[0])]
    df = spark.createDataFrame(docs + docs[:7], "doc_id long, text string").withColumn("line_no", F.lit("x"))
    got = line_dedup.line_classes(df).collect()
    again = [r for r in got if r.doc_id is not None and r.doc_id < 7]
    for r in again[:]:  # rows that are repeated whole give their lines twice
        assert again.count(r) % 2 == 0
    once, twice = [], []
    for r in got:
        (twice if r in once and r in again else once).append(r)
    assert len(twice) * 2 == len(again)
    got = once
    lines = {}
    for d, t in docs:
        for i, x in enumerate((t or "").split("\n")):
            if x.strip():
                lines[(d is None, d or 0, i)] = x.strip()
    texts = set(lines.values())
    links = [(a, b) for a, b in combinations(sorted(texts), 2) if abs(len(a) - len(b)) <= 2 and edits(a, b) <= min(2, min(len(a), len(b)) // 12)]
    root = groups(texts, links)
    first, degree = {}, defaultdict(int)
    for place in sorted(lines):
        first.setdefault(root[lines[place]], place)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert len(got) == len(lines)
    for r in got:
        place = (r.doc_id is None, r.doc_id or 0, r.line_no)
        want = first[root[lines[place]]]
        assert (r.class_doc_id is None, r.class_doc_id or 0, r.class_line_no) == want
        assert r.dropped == (place != want) and r.n_links == degree[lines[place]]


def test_dropping_lines(spark):
    a = "a line of some length to be repeated here"
    rows = [(1, f"{a}\nmenu\nunique words of the first document"), (2, f"menu\n{a[:-1]}\nother words of the second document"), (3, a), (4, None), (5, ""), (6, f"x\n{a}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "_d": F.lit(1), "h": F.lit(2), "line_no": F.lit(3)})
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got == {1: rows[0][1], 2: "other words of the second document", 4: None, 5: "", 6: "x"}
    assert line_dedup.line_classes(df.limit(0)).count() == 0


def test_sketch_bound():
    rnd = random.Random(6)
    for _ in range(500):
        a = "".join(rnd.choices("abcdefgh é中", k=40))
        s = line_dedup.sketches([a, changed(rnd, a, 2, "xyz é")])
        assert int(s[0] ^ s[1]).bit_count() <= 4 and s[0] >= 0


URLS = [
    (1, "http://NET/"), (2, "x://a.net"), (3, "https://blog.example.net/en/1?x"), (4, None), (5, "example.com/de/"), (6, "http://example.com/de/x#y"), (7, "http://a.org/fr/"), (8, "http://badexample.com/de/"),
    (9, "http://net/"), (10, "https://x.casino-win.example.com/p"), (11, "https://casino-win.example.com"), (12, "http://a.example.net/EN/"), (13, "://host.net/?q"), (14, ""), (14, ""), (None, "http://net/"), (15, "a\n://b.org/fr/\n"),
]


def judge(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = lambda h, p: host and (host == h or host.endswith("." + h)) and path.startswith(p)
    rules = sorted((len(h + p), h + p, v) for h, p, v in url_filter.RULES if fits(h, p))
    if rules:
        return host, path, rules[-1][1], rules[-1][2]
    path_ = path or "/"  # the list is held against the canonical path
    listed = any(host and (host == h or host.endswith("." + h)) and path_.startswith("/" + p) for h, _, p in (e.partition("/") for e in url_filter.default_list()))
    return host, path, None, "block" if listed else "allow"


def test_url_rules(spark):
    rows = URLS + [(r.page_id + 100, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("x"), "rule": F.lit(1)})
    got = url_filter.judge_urls(df, url_filter.default_entries(spark)).collect()
    assert len(got) == len(rows)
    assert sorted((repr(r.page_id), r.host, r.path, r.rule or "", r.verdict) for r in got) == sorted((repr(i), *[x or "" for x in judge(u)]) for i, u in rows)
    assert url_filter.judge_urls(df.limit(0), url_filter.default_entries(spark)).count() == 0
    assert url_filter.judge_urls(df, url_filter.default_entries(spark).limit(0)).filter("verdict <> 'allow'").count() == 0


def test_bloom_has_no_false_negatives():
    keys = [f"host{i}/p" for i in range(5000)]
    bloom = url_filter.BlockedBloom(len(keys))
    bloom.add(url_filter.key_hashes(keys))
    assert bloom.may_hold(url_filter.key_hashes(keys)).all()
    assert bloom.may_hold(url_filter.key_hashes([f"other{i}" for i in range(5000)])).mean() < 0.02
