"""SpotSigs: signatures from chains of content words that follow common words.

A spot is an anchor (a common word) and the next ``CHAIN`` content words, with all
common words in between skipped, however many.  A text's signature set is the set of its hashed
spots; texts without a spot have the hash of their words, texts without a word the
empty set.  Comparison is Jaccard on these sets; the near-duplicate join splits sets
by length, indexes only a prefix of each set's rarest spots, and prunes by length
before it verifies.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.runtime import cut

#: Common words of English, French, German and Spanish (fixed values).
ANCHORS = (
    "a and are as at be by for from in is it of on that the this to was with "
    "au avec dans de des du elle en est et la le les ou par pas pour que qui sur un une "
    "auf das dem den der die ein im ist mit nicht sich und von zu "
    "con del el es los no por se su una y"
).split()
CHAIN = 2
#: Letters of anchors move into this range of private characters, so that a run of anchors is a run of one character class.
PRIVATE = 0xE000
RUN = f"[{chr(PRIVATE)}-{chr(PRIVATE + 0x3FF)}]"
BREAK = chr(PRIVATE)  # ends an anchor


def _words(text: Column) -> Column:
    """Lower-case words with a space between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _coded(words: Column) -> Column:
    """Words in one text: a content word and a space, an anchor in private characters and BREAK."""
    letters = "".join(sorted({c for a in ANCHORS for c in a}))
    private = "".join(chr(PRIVATE + 1 + i) for i in range(len(letters)))
    each = F.transform(
        F.split(words, " "), lambda w: F.when(w.isin(*ANCHORS), F.concat(F.translate(w, letters, private), F.lit(BREAK))).otherwise(F.concat(w, F.lit(" ")))
    )
    return F.array_join(each, "")


def _chains(coded: Column) -> Column:
    """Each run of anchors with the content words of its chain, as text; a chain skips anchors, however many.

    A run is read where it begins and as the gap of at most CHAIN - 1 earlier chains, so the
    work is in proportion to the text.
    """
    return F.regexp_extract_all(coded, F.lit(f"(?<!{RUN})(?=({RUN}++(?:[^ ]++ ){{{CHAIN}}}))"), 1)


def _spots(chains: Column) -> Column:
    """Array of arrays: for each run of anchors its different anchors, each hashed with the chain behind the run."""

    def of(chain: Column) -> Column:
        run = F.regexp_extract(chain, f"^{RUN}++", 0)
        content = F.regexp_replace(chain, f"{RUN}++", "")
        anchors = F.filter(F.array_distinct(F.split(run, BREAK)), lambda a: a != "")
        return F.transform(anchors, lambda a: F.hash(a, content))

    return F.transform(chains, of)


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds sorted distinct 32-bit hashes of a text's spots; null text is empty.

    Steps are columns of their own, as a column read twice is not put in place of its name:
    words and chains are sought once.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    words = _words(text)
    bare = F.when(F.length(F.trim(text)) == 0, F.array().cast("array<int>")).otherwise(F.array(F.hash(F.when(words != "", words).otherwise(text))))
    found = df.withColumn("_chains", _chains(_coded(words))).withColumn("_spots", F.sort_array(F.array_distinct(F.flatten(_spots(F.col("_chains"))))))
    return found.withColumn(out, F.when(F.size("_spots") > 0, F.col("_spots")).otherwise(bare)).drop("_chains", "_spots")


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets without repeats; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union).cast("double")


def fingerprint(sig: Column) -> Column:
    """A set as text: eight hex digits for each spot."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(F.pmod(x.cast("long"), F.lit(1 << 32))), 8, "0"))), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, need) distinct ids -> (doc_id, next_id, need): the next id in ascending order, after the last the first.

    Ids are dealt by range; each range looks up its own successor and the ranges' first
    ids, one row a range, close the gaps.  A null id is last.
    """
    spark = ids.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_last())
    heads = dealt.withColumn("r", F.row_number().over(inside)).filter("r = 1").select("part", F.col("doc_id").alias("head"))
    after = Window.orderBy("part")
    heads = heads.select(
        "part", F.coalesce(F.lead(F.struct("head")).over(after), F.first(F.struct("head")).over(Window.partitionBy(F.lit(1)).orderBy("part"))).alias("jump")
    )
    return (
        dealt.withColumn("ahead", F.lead(F.struct("doc_id")).over(inside)).join(F.broadcast(heads), "part")
        .select("doc_id", "need", F.coalesce(F.col("ahead.doc_id"), F.when(F.col("ahead").isNull(), F.col("jump.head"))).alias("next_id"))
    )


def _heads(met: DataFrame, single: bool) -> DataFrame:
    """(text, sig, for_id, need) -> (doc_id, head, next_sig): the beginning that a document takes over, of the text that sorts first if there are several."""
    if not single:
        met = met.groupBy("for_id").agg(F.first("need").alias("need"), F.min(F.struct("text", "sig")).alias("m")).select("for_id", "need", "m.text", "m.sig")
    return met.select(F.col("for_id").alias("doc_id"), F.expr("substring(text, 1, need)").alias("head"), F.col("sig").alias("next_sig"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n/2) code points replaced by the first as many (or
    all) of the next document.  Null text is empty.  Rows that repeat a doc_id each keep
    their row and share the next document, that of the next larger id; of rows that repeat
    this id the alphabetically smallest text is meant.  A null doc_id counts as the largest.
    Other columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = base.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 2)).cast("int").alias("need"), F.count("*").alias("rows"))
    ids = cut(ids)
    single = ids.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0] <= 1
    plan = cut(next_ids(ids.select("doc_id", "need")).select(F.col("doc_id").alias("for_id"), "need", "next_id"))
    signed = with_signature(base, "text", "sig")
    # the same columns for both joins, so that the texts are dealt out once and read twice; rows without an id are dealt by their text
    onto = signed.filter("doc_id is not null").select("doc_id", "text", "sig")
    heads = onto.join(plan.filter("for_id is not null and next_id is not null").select(F.col("next_id").alias("doc_id"), "for_id", "need"), "doc_id")
    heads = _heads(heads, single)
    if ids.filter("doc_id is null").count():
        least, last = base.filter("doc_id is null").agg(F.min("text").alias("text")), plan.filter("next_id is null and for_id is not null").select("for_id", "need")
        heads = heads.unionByName(_heads(with_signature(least, "text", "sig").join(last, F.lit(True)), True))
        after = plan.filter("for_id is null").select("next_id", "need").first()
        mine = onto.filter(F.col("doc_id") == after["next_id"]) if after["next_id"] is not None else with_signature(least, "text", "sig").select(F.lit(None).cast("long").alias("doc_id"), "text", "sig")
        first = _heads(mine.agg(F.min(F.struct("text", "sig")).alias("m")).select("m.text", "m.sig", F.lit(0).cast("long").alias("for_id"), F.lit(after["need"]).alias("need")), True)
        unnamed = signed.filter("doc_id is null").select("doc_id", "text", "sig").join(F.broadcast(first.drop("doc_id")), F.lit(True))
    else:
        unnamed = None
    both = onto.join(heads, "doc_id")
    both = both if unnamed is None else both.unionByName(unnamed)
    both = both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig",
        F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(head, 1, cast(floor(length(text) / 2) as int))")).alias("edited"),
    )
    marked = with_signature(both.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_sig")
    return marked.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        jaccard(F.col("sig"), F.col("edited_sig")).alias("near_edited"), jaccard(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) -> members (doc_id, class_id) and pairs (class_a, class_b, likeness).

    Documents of one signature set are one class, named by its smallest doc_id; pairs are
    between classes whose Jaccard likeness reaches ``threshold``.  A set is probed by the
    prefix of its spots, rarest first, that two such sets must share, and only against
    length partitions that can reach the threshold.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(with_signature(base, "text", "sig").select("doc_id", "sig"))
    classes = cut(signed.groupBy("sig").agg(F.min("doc_id").alias("class_id")).withColumn("n", F.size("sig")))
    members = signed.join(classes, "sig").select("doc_id", "class_id")
    spots = classes.filter("n > 0").select("class_id", "n", F.explode("sig").alias("spot"))
    common = spots.groupBy("spot").agg(F.count("*").alias("df"))
    rare = Window.partitionBy("class_id").orderBy("df", "spot")
    ratio = math.log(1 / threshold)
    prefix = (
        spots.join(common, "spot").withColumn("i", F.row_number().over(rare))
        .filter(F.col("i") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        .select("class_id", "n", "spot", F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int").alias("part"))
    )
    prefix = cut(prefix)
    probe = prefix.select(
        F.col("class_id").alias("a"), F.col("n").alias("na"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part")
    )
    pairs = (
        probe.join(prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "spot", "part"), ["spot", "part"])
        .filter("(na < nb or na = nb and a < b)").filter(F.col("na") >= F.col("nb") * threshold - 1e-9).select("a", "b").distinct()
    )
    one = classes.select(F.col("class_id").alias("a"), F.col("sig").alias("sa"))
    two = classes.select(F.col("class_id").alias("b"), F.col("sig").alias("sb"))
    found = pairs.join(one, "a").join(two, "b").withColumn("likeness", jaccard(F.col("sa"), F.col("sb"))).filter(F.col("likeness") >= threshold)
    return members, found.select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b"), "likeness")
