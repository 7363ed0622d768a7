"""Documents of several sources, mixed to target weights by systematic sampling.

Sources share a budget of words by weight, up to a number of times their own size. Every document
of a source is then expected equally often. The expected copies are summed up over the source's
documents, one random offset is added, and a copy comes out for every whole number that the sum
crosses at a document. Documents stand by size in this sum, so that what a source gives is less
than its longest text away from its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import fresh, stored
from eventmetrics.llm.ranks import numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: A source, and a document, comes at most so many times.
MOST = 3
#: Shares settle in a few rounds: each is a Newton step on a concave sum of straight pieces.
MAX_ROUNDS = 200


def share_out(sources: DataFrame, most: int) -> DataFrame:
    """The stored sources (size, weight), with the target of each.

    All sizes together are shared by weight. A source whose share would be above `most` times its size
    gets that, and the others share the rest, until none is above.
    """
    cap = F.col("size") * most
    total = sources.agg(F.sum("size")).first()[0] or 0
    shared, level = None, 0.0
    for _ in range(MAX_ROUNDS):
        full = F.lit(False) if shared is None else F.col("weight") * F.lit(level) > cap
        # Sums of whole numbers, so they do not depend on the order of the rows.
        open_weight, taken, n = sources.agg(
            F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap)),
            F.count_if(full)).first()
        if shared == n:
            return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(
                F.col("weight") * F.lit(level)))
        shared = n
        level = float(total - (taken or 0)) / float(open_weight or 1)
    raise RuntimeError(f"shares did not settle in {MAX_ROUNDS} rounds")


def _offset(source: Column) -> Column:
    """A number from 0 to 1 that the source's name decides, always the same."""
    name = F.coalesce(F.concat(F.lit("source:"), source), F.lit("none"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            weights: Sequence[int] = WEIGHTS, most: int = MOST,
            columns: Sequence[str] | None = None) -> DataFrame:
    """Every row, stored, with size (its words), source_size, target (the source's) and copies.

    Sources weigh `weights` by turns, in the order of their code points; rows without a source are
    one, the last. A null text has no words. A source without words has the target 0 and gives no
    copies. Rows that repeat each other are documents of their own. `columns` are carried along,
    by default all; new names that are taken get a trailing underscore. No rows give no rows.
    """
    columns = list(docs.columns if columns is None else columns)
    size, source_size, target, copies = (
        fresh(docs, c) for c in ("size", "source_size", "target", "copies"))
    key, at = fresh(docs, "source_of_row"), fresh(docs, "place_in_source")
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    base = stored(docs.select(*dict.fromkeys([*columns, doc_id]), words.alias(size),
                              F.col(source).cast("string").alias(key)))
    sources = base.groupBy(key).agg(F.sum(size).alias("size"), F.count("*").alias("rows"))
    ranked = numbered(sources, [F.asc_nulls_last(key)], "turn")
    weight = F.array(*[F.lit(w).cast("bigint") for w in weights])[
        F.pmod("turn", F.lit(len(weights))).cast("int")]
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    targets = stored(share_out(stored(ranked.withColumn("weight", weight)), most).select(
        F.col(key).alias("name"), F.col("size").alias("source_words"),
        F.col("target").alias("source_target"), rate.alias("rate"),
        _offset(F.col(key)).alias("offset")))
    placed = numbered(base, [F.desc(size), F.asc_nulls_first(doc_id)], at, [key])
    # Whole copies apart from the rest, so that rounding never adds one to a document.
    whole = F.floor("rate")
    rest = F.col("rate") - whole
    crossed = (F.floor((F.col(at) + 1) * rest + F.col("offset"))
               - F.floor(F.col(at) * rest + F.col("offset")))
    return placed.join(targets, F.col(key).eqNullSafe(F.col("name"))).select(
        *columns, size, F.col("source_words").alias(source_size),
        F.col("source_target").alias(target), (whole + crossed).cast("bigint").alias(copies))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixture itself: each row as often as `mixture` takes it, with a column copy (from 1)."""
    taken = mixture(docs, doc_id, text, source, weights, most)
    times, copy = taken.columns[-1], fresh(docs, "copy")
    return taken.filter(F.col(times) > 0).select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(copy))
