"""Identity keys, ordered deduplication, key joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.runtime import cut, discard


def filled_identity(df: DataFrame) -> DataFrame:
    """Published (ats_type, ats_id), both taken from the link if either is missing."""
    clean = lambda c: F.when(F.lower(F.trim(T.text(F.col(c)))).isin("", "nan", "none", "null", "nat"), "").otherwise(F.trim(T.text(F.col(c))))
    kind, ident = clean("ats_type"), clean("ats_id")
    missing = (kind == "") | (ident == "")
    found = df.withColumn("_found", F.when(missing, U.infer_identity(F.col("link"))))
    return found.withColumns(
        {"ats_type": F.coalesce("_found.kind", kind), "ats_id": F.coalesce("_found.id", ident)}
    ).drop("_found")


def identity_coverage(df: DataFrame) -> DataFrame:
    """One row (rows, identified, pct) after ids are filled from links."""
    known = (F.col("ats_type") != "") & (F.col("ats_id") != "")
    counts = filled_identity(df).agg(F.count("*").alias("rows"), F.count_if(known).alias("identified"))
    return counts.withColumn("pct", F.round(100.0 * F.col("identified") / F.greatest("rows", F.lit(1)), 2))


def identity_key(kind: Column, ident: Column, link: Column, company: Column, role: Column, location: Column) -> Column:
    """``id|``, else ``url|``, else ``details|`` key of a posting."""
    url = U.canonical(link)
    details = F.concat_ws("|", F.lit("details"), T.employer_key(company), T.fold(role), T.fold(location))
    return (
        F.when((T.text(kind) != "") & (T.text(ident) != ""), F.concat_ws("|", F.lit("id"), F.lower(T.text(kind)), T.text(ident)))
        .when(url != "", F.concat(F.lit("url|"), url)).otherwise(details)
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order; null keys are one key."""
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", row).filter("_rn = 1").drop("_rn")


def new_rows(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the known ones; null keys compare as equal."""
    marks = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(marks, on, "left_anti")


def known_rows(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    marks = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    return rows.join(marks, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_semi")


#: Undecided rows that one task may hold: three short values each.
FOLDED = 200_000


def _first_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (_o, _a, _b) in order the rows whose keys no earlier kept row has."""
    a_seen: set[str] = set()
    b_seen: set[str] = set()
    for batch in batches:
        ok = []
        for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            free = (a is None or a not in a_seen) and (b is None or b not in b_seen)
            ok.append(free)
            if free:
                a_seen.add(a)
                b_seen.add(b)
        yield batch.filter(pa.array(ok, pa.bool_())).select(["_o"])


def either_key(df: DataFrame, first: str, second: str, ordinal: str) -> DataFrame:
    """Greedy first-fit: in order of ``ordinal`` a row stays unless one that stayed has its first or second key.

    Rows without a key stay; a dropped row registers none.  Each round decides every row
    that is the earliest undecided one of all its keys and drops those that meet its keys,
    so rounds grow with the longest chain of rows that block one another; the last
    ``FOLDED`` undecided rows are folded in order by one task.
    """
    blank = lambda c: F.when(T.text(F.col(c)) != "", T.text(F.col(c)))
    base = df.select(F.col(ordinal).alias("_o"), blank(first).alias("_a"), blank(second).alias("_b"))
    count = lambda c: F.when(F.col(c).isNull(), 1).otherwise(F.count("*").over(Window.partitionBy(c)))
    # null keys would meet in one task: their rows are decided without the window
    lone = base.filter("_a is null and _b is null").select("_o")
    with_a, without_a = base.filter("_a is not null").withColumn("_na", count("_a")), base.filter("_a is null and _b is not null").withColumn("_na", F.lit(1).cast("long"))
    rest = with_a.unionByName(without_a)
    with_b = rest.filter("_b is not null").withColumn("_nb", count("_b"))
    marked = cut(with_b.unionByName(rest.filter("_b is null").withColumn("_nb", F.lit(1).cast("long"))))
    kept = lone.unionByName(marked.filter("_na = 1 and _nb = 1").select("_o"))
    open_ = cut(marked.filter("_na > 1 or _nb > 1").select("_o", "_a", "_b"))
    done = []
    while (left := open_.count()) > FOLDED:
        low_a = open_.filter("_a is not null").groupBy("_a").agg(F.min("_o").alias("_la"))
        low_b = open_.filter("_b is not null").groupBy("_b").agg(F.min("_o").alias("_lb"))
        seen = open_.join(low_a, "_a", "left").join(low_b, "_b", "left")
        win = cut(seen.filter("(_a is null or _o = _la) and (_b is null or _o = _lb)").select("_o", "_a", "_b"))
        done.append(win)
        after = cut(
            open_.join(win.select(F.col("_o").alias("_w")), F.col("_o") == F.col("_w"), "left_anti")
            .join(win.filter("_a is not null").select(F.col("_a").alias("_wa")).distinct(), F.col("_a") == F.col("_wa"), "left_anti")
            .join(win.filter("_b is not null").select(F.col("_b").alias("_wb")).distinct(), F.col("_b") == F.col("_wb"), "left_anti")
        )
        discard(open_)
        open_ = after
    for win in done:
        kept = kept.unionByName(win.select("_o"))
    if left:
        kept = kept.unionByName(cut(open_.coalesce(1).sortWithinPartitions("_o").mapInArrow(_first_fit, f"_o {open_.schema['_o'].dataType.simpleString()}")))
    return df.join(kept, df[ordinal] == kept["_o"], "left_semi")


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, and the values in order."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values")).filter(F.size("values") > 1).withColumn("n_values", F.size("values").cast("long"))
