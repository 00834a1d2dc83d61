"""Mixing sources to target weights by blocks.

Each source's words are one stream, cut into blocks of fixed length.  Output
shards draw multinomial source counts from hashed uniforms; the draws of a source
are numbered through all shards, and what a source draws beyond its quota goes to
the sources that drew less, so totals hold exactly.  The n-th slot of a source
takes the block that a pseudorandom permutation of its block indexes (swap-or-not
shuffle) gives to n modulo the number of blocks; slots and blocks meet in a join
by (source, index).  DataFrame functions only; every order is explicit and every
draw a hash, so reruns agree.

Sums over shards, chunks or documents in order go in two steps, totals of stretches
first, so that no window holds more than a stretch or the totals; which source a draw
falls to is an equi-join by cell of the unit interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.runtime import cut

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
#: Rows of an order that a window holds, and documents of a chunk of a source's stream.
STRETCH = 4096
CHUNK_ROWS = 8192
#: Cells of the unit interval in which draws meet sources, and sources up to which their table goes to every task.
CELLS = 4096
BROADCAST_SOURCES = 50_000
ROUNDS = 16
SEED = 7


def word_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # a word begins where something other than white space follows white space or the start
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> source, rank, source_size, target.

    Sources by code point, null last, weigh ``weights`` in turn and split ``share`` of all
    sizes; no target passes ``most`` times its source's size: sources fill in the order of
    limit over weight, and the level at which the rest is split is the same for all.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") % len(weights)) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", pick)
    ranked = ranked.withColumn("limit", F.col("source_size") * float(most))
    by_fill = Window.orderBy((F.col("limit") / F.col("weight")).asc(), "rank")
    everything = Window.partitionBy(F.lit(1))
    filled = (
        ranked.withColumn("goal", F.sum("source_size").over(everything) * share)
        .withColumn("before", F.coalesce(F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("goal") - F.col("before")) / F.col("rest"))
        .withColumn("open", F.col("weight") * F.col("level") <= F.col("limit"))
        .withColumn("final", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("rank"), F.col("level").alias("l")))).over(everything))
    )
    return filled.select(
        "source", "rank", "source_size",
        F.when(F.col("final").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("weight") * F.col("final.l"))).alias("target"),
    )


def _uniform(*cols: Column) -> Column:
    """[0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) / float(1 << 53)


def permuted(index: Column, n: Column, key: Column) -> Column:
    """Swap-or-not shuffle of 0..n-1 under ``key``."""
    keys = F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.pmod(F.xxhash64(F.lit(SEED), key, r), n))

    def turn(x: Column, k: Column) -> Column:
        other = F.pmod(k - x, n)
        return F.when(F.pmod(F.xxhash64(k, key, F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(keys, index, turn)


def upto(df: DataFrame, keys: list[str], order: str, value: str, out: str, stretch: int = STRETCH) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of a key up to this one, by the whole number ``order``, of which a key has each once.

    A window holds a stretch of a key, or one total for each of its stretches.
    """
    part = F.floor(F.col(order) / stretch).cast("long")
    rows = df.withColumn("_part", part)
    totals = rows.groupBy(*keys, "_part").agg(F.sum(value).alias("_total"))
    before = totals.withColumn("_base", F.sum("_total").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_total")).drop("_total")
    inside = F.sum(value).over(Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_in", inside).join(before, [*keys, "_part"]).withColumn(out, F.col("_base") + F.col("_in")).drop("_part", "_base", "_in")


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a table of ``rows`` rows, sent to every task only up to a size."""
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def block_quota(plan: DataFrame, block_words: int, most: int = MOST) -> DataFrame:
    """Blocks and slots of each source, and where its share of the unit interval begins and ends."""
    everything = Window.partitionBy(F.lit(1))
    sized = plan.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long")).withColumn(
        "quota", F.least(F.col("blocks") * most, F.round(F.col("target") * F.col("blocks") / F.greatest(F.col("source_size"), F.lit(1))).cast("long"))
    )
    return (
        sized.withColumn("total", F.sum("quota").over(everything)).withColumn("end", F.sum("quota").over(Window.orderBy("rank")))
        .withColumn("high", F.col("end") / F.greatest("total", F.lit(1))).withColumn("low", (F.col("end") - F.col("quota")) / F.greatest("total", F.lit(1))).drop("end")
    )


def draw_counts(quota: DataFrame, total: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, rank, n): each shard's multinomial counts, brought to the quotas.

    A source's surplus is what its running count has beyond its quota; the surplus
    slots in order of (shard, rank) go to the sources still short, in order of rank.
    """
    spark, sources = quota.sparkSession, quota.count()
    cells = quota.filter("quota > 0").select(
        "rank", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * CELLS).cast("int"), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)).cast("int"))).alias("cell")
    )
    draws = spark.range(total).select((F.col("id") / shard_slots).cast("long").alias("shard"), _uniform(F.col("id")).alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
    # `high` of one source is `low` of the next, the same number, so each draw falls to one source
    drawn = (
        draws.join(few(cells, sources), "cell").filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
        .groupBy("shard", "rank").agg(F.count("*").alias("n"))
    )
    held = upto(cut(drawn), ["rank"], "shard", "n", "upto").join(few(quota.select("rank", "quota"), sources), "rank")
    kept = cut(
        held.withColumn("keep", F.greatest(F.lit(0), F.least("n", F.col("quota") - F.col("upto") + F.col("n"))).cast("long"))
        .withColumn("over", F.col("n") - F.col("keep"))
    )
    short = quota.join(kept.groupBy("rank").agg(F.sum("keep").alias("got")), "rank", "left").withColumn(
        "lack", F.col("quota") - F.coalesce("got", F.lit(0))
    ).withColumn("lack_end", F.sum("lack").over(Window.orderBy("rank"))).filter("lack > 0").select(F.col("rank").alias("to"), "lack", "lack_end")
    spare = kept.filter("over > 0").groupBy("shard").agg(F.sum("over").alias("over"), F.lit(0).alias("line"))
    spare = upto(spare, ["line"], "shard", "over", "over_end").select("shard", "over", "over_end")
    # both sides are runs of one line of slots: runs that overlap, met by stretches of the line, say who gets what
    run = lambda df, size, end: df.withColumn(
        "cell", F.explode(F.sequence(F.floor((F.col(end) - F.col(size)) / STRETCH).cast("long"), F.floor((F.col(end) - 1) / STRETCH).cast("long")))
    )
    low, high = F.greatest(F.col("over_end") - F.col("over"), F.col("lack_end") - F.col("lack")), F.least("over_end", "lack_end")
    moved = (
        run(spare, "over", "over_end").join(run(short, "lack", "lack_end"), "cell").filter(low < high)
        .filter(F.col("cell") == F.floor(low / STRETCH))  # runs that share several stretches meet once
        .select("shard", F.col("to").alias("rank"), (high - low).cast("long").alias("n"))
    )
    return kept.select("shard", "rank", F.col("keep").alias("n")).unionByName(moved).groupBy("shard", "rank").agg(F.sum("n").alias("n")).filter("n > 0")


def slots(quota: DataFrame, counts: DataFrame) -> DataFrame:
    """(shard, slot, rank, block, pass): the block that each output slot takes."""
    numbered = upto(cut(counts), ["rank"], "shard", "n", "upto").withColumn("first", F.col("upto") - F.col("n")).join(few(quota.select("rank", "blocks"), quota.count()), "rank")
    # a few count rows make thousands of slots each: by number, or they would be gathered in one task
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = numbered.repartition(parts, "shard", "rank").select(
        "shard", "rank", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot")
    )
    return each.select(
        "shard", "slot", "rank", (F.col("slot") / F.col("blocks")).cast("long").alias("pass"),
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("rank")).alias("block"),
    )


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, k): a row for each document; k numbers those equal in the other three, from 1.

    Rows that nothing tells apart are counted and dealt out again, which no window has to hold.
    """
    counted = docs.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    step = 1 << 16
    runs = counted.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))))
    return runs.select("doc_id", "source", "size", F.explode(F.sequence(F.col("at") * step + 1, F.least((F.col("at") + 1) * step, "n"))).alias("k"))


def stream_places(sizes: DataFrame, rows: int) -> DataFrame:
    """Adds ``start``: where a document's words begin in its source's stream.

    The stream runs by (hash chunk, doc_id, size, k); the number of chunks follows the
    number of documents and chunk totals are summed first, so a window holds about
    ``CHUNK_ROWS`` documents of a source.
    """
    chunks = max(64, -(-rows // CHUNK_ROWS))
    row = sizes.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size", "k"), F.lit(chunks)).cast("long"))
    totals = row.groupBy("rank", "chunk").agg(F.sum("size").alias("chunk_size"))
    base = upto(totals, ["rank"], "chunk", "chunk_size", "end").withColumn("base", F.col("end") - F.col("chunk_size"))
    inside = Window.partitionBy("rank", "chunk").orderBy("doc_id", "size", "k").rowsBetween(Window.unboundedPreceding, 0)
    return (
        row.withColumn("upto", F.sum("size").over(inside)).join(base.select("rank", "chunk", "base"), ["rank", "chunk"])
        .withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("upto", "base", "chunk")
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, source) -> documents with their places, and the pieces the mix takes.

    Documents: row, doc_id, source, k, rank, size, source_size, target, start.  Pieces: row,
    shard, slot, pass, from, words (a document's words in one taken block).  Null text has
    size 0; null is a source of its own, last in order; repeated rows are documents of their
    own, numbered by k; wordless documents are in no piece; an empty table gives two empty frames.
    """
    sized = cut(numbered_rows(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))
    ).withColumn("row", F.monotonically_increasing_id()))
    plan = cut(targets(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), weights, share, most))
    quota = cut(block_quota(plan, block_words, most))
    total = quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    named = sized.withColumnRenamed("source", "_s").join(few(plan, plan.count()), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    placed = cut(stream_places(named, sized.count()))
    taken = slots(quota, draw_counts(quota, total)) if total else None
    blocks = placed.filter("size > 0").select(
        "row", "rank", "start", "size",
        F.explode(F.sequence((F.col("start") / block_words).cast("long"), ((F.col("start") + F.col("size") - 1) / block_words).cast("long"))).alias("block"),
    ).select(
        "row", "rank", "block",
        F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0)).alias("from"),
        (F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size")) - F.greatest(F.col("block") * block_words, F.col("start"))).alias("words"),
    )
    if taken is None:
        return placed, blocks.select("row", F.lit(0).alias("shard"), F.lit(0).alias("slot"), F.lit(0).alias("pass"), "from", "words").limit(0)
    return placed, blocks.join(taken, ["rank", "block"]).select("row", "shard", "slot", "pass", "from", "words")


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    placed, pieces = mix(docs, block_words)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns of ``docs``; a row for each document and pass, its text cut to the words that pass takes.

    Neighbouring blocks of a document stay joined as they were in the text; where blocks
    in between aren't taken, what follows begins on a new line.  n_chars, if there, is
    counted anew.
    """
    placed, pieces = mix(docs, block_words)
    runs = pieces.groupBy("row", F.col("pass").alias("__pass")).agg(F.sort_array(F.collect_list(F.struct("from", "words"))).alias("__runs"))
    chosen = runs.join(placed.select("row", F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.col("source").alias("__src"), F.col("k").alias("__k")), "row")
    numbered = docs.withColumn("__n", word_count(F.col("text").cast("string")))
    same = Window.partitionBy("doc_id", "source", "__n").orderBy(F.xxhash64("text"))
    left = numbered.withColumn("__k", F.row_number().over(same).cast("long"))
    right = chosen.drop("row")
    on = left.doc_id.eqNullSafe(right["__id"]) & left.source.eqNullSafe(right["__src"]) & (left["__n"] == right["__size"]) & (left["__k"] == right["__k"])
    joined = left.join(right, on)
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD}{SPACE[:-1]}*)"), 1)
    whole = F.aggregate("__runs", F.lit(0).cast("long"), lambda a, r: a + r["words"]) == F.col("__n")
    joined = joined.withColumn("__w", F.when(~whole, words))

    def add(acc: Column, r: Column) -> Column:
        part = F.array_join(F.slice("__w", (r["from"] + 1).cast("int"), r["words"].cast("int")), "")
        gap = F.when((acc["end"] == r["from"]) | (acc["end"] < 0), F.lit("")).otherwise(F.lit("\n"))
        return F.struct(F.concat(acc["text"], gap, part).alias("text"), (r["from"] + r["words"]).alias("end"))

    cut_text = F.rtrim(F.aggregate("__runs", F.struct(F.lit("").alias("text"), F.lit(-1).cast("long").alias("end")), add, lambda a: a["text"]))
    out = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(cut_text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
