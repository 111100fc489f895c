"""Line dedup by a suffix array over line-ID sequences; DataFrame functions only.

Distributed prefix doubling: round k sorts suffixes by the pair of ranks of their
first and next 2^k lines. Suffixes with one rank after a round form an interval of
the suffix array with a common prefix of at least as many lines, so the rounds
name the intervals of doubling depth. Suffixes that are alone drop out, and what
is left shrinks to the repeated lines of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terralattice import session
from terralattice.llm.common import LEAST, order_id

MIN_LINES = 2
_PLACE = ("doc", "tag", "pos")


def _lines(text: str) -> Column:
    """Lines that hold a word, each with the blank lines after it; blank lines at the top come first."""
    return F.split(text, r"\n(?=[^\n]*[^\x20\x09-\x0D])")


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _sequences(docs: DataFrame) -> DataFrame:
    """doc, tag, pos, name: the lines with a word, by their number and a 128-bit hash."""
    named = F.transform(_lines("text"), lambda line: F.when(_worded(line), F.unhex(F.md5(F.substring_index(line, "\n", 1)))))
    return docs.select("doc", "tag", F.posexplode(named).alias("pos", "name")).where("name is not null")


def _ranked(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct keys with `rank`, ascending with the keys; ranks have gaps.

    A range shuffle and a sort within its partitions put keys in order, so that
    an id that ascends with the partition and the row is a rank.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).withColumn("rank", F.monotonically_increasing_id())


def _round(suffixes: DataFrame, columns: list[str]) -> DataFrame:
    """Suffixes that are not alone, with the rank of their interval and its first place in the corpus."""
    first = F.min(F.struct("doc", "pos", "tag")).alias("first")
    keys = suffixes.groupBy(*columns).agg(F.count("*").alias("n"), first).where("n > 1").select(*columns, "first")
    return session.materialize(
        suffixes.join(session.materialize(_ranked(keys, columns), "line-ranks"), columns).select(*_PLACE, "rank", "first"), "line-suffixes")


def _paired(suffixes: DataFrame, step: int) -> DataFrame:
    """Suffixes with their rank, `here`, and the rank `step` lines further on, `ahead`. Those go
    whose partner is alone or past the end, for then they are alone, too."""
    further = Window.partitionBy("doc", "tag").orderBy("pos").rangeBetween(step, step)
    return suffixes.select(*_PLACE, F.col("rank").alias("here"), F.first("rank").over(further).alias("ahead")).where("ahead is not null")


def intervals(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc, tag, pos, lines, first: per line of the corpus that starts a repeat of `min_lines`
    or more lines, the intervals it lies in: `lines` they have in common at least, and where
    the first copy starts (doc, pos, tag).

    `docs` has doc and tag (never null) and text. Repeated rows of a document
    must have been made one.
    """
    found = None
    lines, suffixes = 1, _round(_sequences(docs), ["name"])
    before = None
    while True:
        if lines <= min_lines < 2 * lines:
            least = suffixes if lines == min_lines else _round(_paired(suffixes, min_lines - lines), ["here", "ahead"])
            found = least.withColumn("lines", F.lit(min_lines))
        elif lines > min_lines:
            found = found.unionByName(suffixes.withColumn("lines", F.lit(lines)))
        state = suffixes.agg(F.count("*").alias("n"), F.countDistinct("rank").alias("ranks")).first()
        if not state["n"] or state == before:
            return found if found is not None else suffixes.withColumn("lines", F.lit(lines)).where("false")
        before = state
        suffixes = _round(_paired(suffixes, lines), ["here", "ahead"])
        lines *= 2


def remove_repeats(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, n_lines, n_removed, longest, kept: texts without later copies of repeated line runs.

    A line goes if it lies in a run of `min_lines` or more lines that also starts
    earlier: in a document with a smaller doc_id, or further up in its own. Lines
    without a word are no part of a run and share the lot of the line above. n_lines counts lines with a word;
    `longest` is the largest power of two of lines, or min_lines, that one removed
    run has in common with its first copy, 0 if there is none.

    Null and empty texts have no lines; a null text is kept as an empty one. A null
    doc_id is smaller than any other; rows that share a doc_id but not the text come
    in the order of their line numbers. Rows repeated whole are treated alike and are
    no copies of each other. Other columns of `docs` are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(order_id().alias("doc"), text.alias("text")).withColumn("tag", F.xxhash64("text"))
    later = intervals(held, min_lines).where(F.struct("first.doc", "first.pos", "first.tag") < F.struct(*[F.col(c) for c in ("doc", "pos", "tag")]))
    gone = later.select("doc", "tag", "lines", F.explode(F.sequence("pos", F.col("pos") + F.col("lines") - 1)).alias("at"))
    per_doc = gone.groupBy("doc", "tag").agg(F.array_sort(F.collect_set("at")).alias("gone"), F.max("lines").alias("longest"))
    joined = held.join(per_doc, ["doc", "tag"], "left")

    # One flag per line up to the last that goes, so that every look-up is one step.
    flags = F.flatten(F.transform("gone", lambda at, i: F.concat(
        F.array_repeat(F.lit(False), at - F.when(i > 0, F.get("gone", i - 1)).otherwise(F.lit(-1)) - 1), F.array(F.lit(True)))))
    out = joined.withColumn("all", _lines("text")).withColumn("flags", flags)
    kept = F.when(F.col("flags").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter("all", lambda line, i: ~F.coalesce(F.get("flags", i), F.lit(False))), "\n"))
    return out.select(
        F.when(F.col("doc") != LEAST, F.col("doc")).alias("doc_id"),
        F.size(F.filter("all", _worded)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("longest"), kept.alias("kept"))
