"""Operator 13: what each filter removes, in every order in which the filters can run.

Every document gets the set of filters that it fails, its failure mask. Masks are counted per part,
and the at most 2**k counts of a part form a count-weighted decision diagram: one level per filter,
the two branches of a node are the documents that pass and that fail it, equal sub-diagrams are
one node. Along the path on which everything passes, the weight of each failing branch is what the filter
at that level removes. Exchanging two adjacent levels touches those two levels only, so all k! orders are
visited by k! - 1 such swaps.

Masks are Spark expressions over whole texts. Which texts repeat is found by digests: rows are
counted per (digest, document) first, so a text with many copies is combined before it is shuffled.

Nulls: a null text is empty, a null part is the empty string; a null document id has no label and counts as larger than
any id. Rows that repeat with the same id are documents of their own and no copies of each other. A document with several label rows is
good (toxic) if one of them says so. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.shipping import ship

SPACE = r"[\x20\x09-\x0D]+"
# Filters by letter; each condition says when a text fails. The last letter, COPY, is "a smaller id has the same text".
COPY = "E"
MAX_FILTERS = 8
LABEL_COUNTS = ("good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Few words, repetitive words, many capitals, symbols."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents per part and set of failed filters; bit i of ``mask`` is the i-th letter."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    fails = list(text_failures(F.col("text")).values())
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))
    # Rows without an id match no label; the spread keeps them from meeting in one task.
    digest = F.unhex(F.sha2("text", 256))
    rows = rows.select("doc_id", "part", mask.alias("mask"), digest.alias("digest"), F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.monotonically_increasing_id())).otherwise(F.lit(0)).alias("spread"))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = rows.join(known.withColumn("spread", F.lit(0).cast("bigint")), ["doc_id", "spread"], "left").na.fill(0, list(LABEL_COUNTS))
    # All copies of a text share its mask. Per text, part and labels: how many rows, and how many of them have the smallest id.
    kind = ["digest", "mask", "part", *LABEL_COUNTS]
    rows = rows.groupBy("doc_id", "spread", *kind).agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))
    rows = rows.groupBy(*kind, order.alias("at")).agg(F.sum("n").alias("n"))
    kinds = rows.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("at", "n")).alias("first"))
    firsts = kinds.groupBy("digest").agg(F.min("first.at").alias("least"))
    kinds = kinds.join(firsts, "digest")
    is_first = F.when(F.col("first.at").eqNullSafe(F.col("least")), F.col("first.n")).otherwise(F.lit(0))
    split = F.array(F.struct(F.lit(0).alias("copy"), is_first.alias("n")), F.struct(F.lit(1 << len(fails)).alias("copy"), (F.col("n") - is_first).alias("n")))
    counted = kinds.select("part", "mask", *LABEL_COUNTS, F.inline(split)).where("n > 0")
    counted = counted.select("part", (F.col("mask") + F.col("copy")).alias("mask"), "n", *[(F.col(c) * F.col("n")).alias(c) for c in LABEL_COUNTS])
    return counted.groupBy("part", "mask").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", *LABEL_COUNTS)])


class Diagram:
    """Quasi-reduced decision diagram with vectors of counts at its ends; level i tests filter ``order[i]``."""

    def __init__(self, filters: int, counts: dict[int, tuple[int, ...]], width: int):
        self.order = list(range(filters))
        self.branches: list[tuple[int, int] | None] = []  # (passing, failing) below a node; None at an end
        self.weight: list[tuple[int, ...]] = []  # counts of all documents below a node
        self.shared: dict[object, int] = {}
        zero = (0,) * width
        level = [self._end(counts.get(self._mask(i, filters), zero)) for i in range(1 << filters)]
        while len(level) > 1:
            level = [self._node(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        self.root = level[0]

    @staticmethod
    def _mask(path: int, filters: int) -> int:
        """The mask of a path whose first level is its highest bit."""
        return sum(1 << i for i in range(filters) if path >> (filters - 1 - i) & 1)

    def _add(self, key: object, branches: tuple[int, int] | None, weight: tuple[int, ...]) -> int:
        if key not in self.shared:
            self.shared[key] = len(self.branches)
            self.branches.append(branches)
            self.weight.append(weight)
        return self.shared[key]

    def _end(self, counts: tuple[int, ...]) -> int:
        return self._add(("end", counts), None, counts)

    def _node(self, passing: int, failing: int) -> int:
        return self._add((passing, failing), (passing, failing), tuple(map(sum, zip(self.weight[passing], self.weight[failing]))))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; nodes below stay as they are, those above are linked anew."""
        done: dict[tuple[int, int], int] = {}

        def moved(node: int, depth: int) -> int:
            if (node, depth) not in done:
                passing, failing = self.branches[node]
                if depth < level:
                    done[node, depth] = self._node(moved(passing, depth + 1), moved(failing, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.branches[passing], self.branches[failing]
                    done[node, depth] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node, depth]

        self.root = moved(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Per level ``(filter, kept, removed)`` along the path on which all filters pass."""
        out, node = [], self.root
        for f in self.order:
            passing, failing = self.branches[node]
            out.append((f, self.weight[passing], self.weight[failing]))
            node = passing
        return out


def swaps(n: int) -> Iterator[int]:
    """Places of the adjacent swaps that lead through all n! orders (plain changes)."""
    if n < 2:
        return
    down = True
    for inner in itertools.chain(swaps(n - 1), [None]):
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + 1 if down else inner
        down = not down


def audited(letters: str, counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, lost ..., shapley)`` of every order and step of one part."""
    k, width = len(letters), len(next(iter(counts.values())))
    diagram = Diagram(k, counts, width)
    found = []
    for at in itertools.chain([None], swaps(k)):
        if at is not None:
            diagram.swap(at)
        found.append((diagram.order.copy(), diagram.steps()))
    fails = {steps[0][0]: steps[0][2][0] for _, steps in found}  # removed by the filter that comes first
    alone = {steps[-1][0]: steps[-1][2][0] for _, steps in found}  # still there for the filter that comes last
    shapley = dict.fromkeys(range(k), 0)
    for _, steps in found:
        for f, _, removed in steps:
            shapley[f] += removed[0]
    return [
        ("".join(letters[f] for f in order), i, kept[0], removed[0], fails[f] - removed[0], alone[f], *removed[1:], shapley[f])
        for order, steps in found
        for i, (f, kept, removed) in enumerate(steps, 1)
    ]


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of ``letters`` and step, from ``failure_counts``; a part is at most 2**k counts."""
    if not 1 <= len(letters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, since every order of them is listed")
    schema = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                steps = audited(letters, {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["counts"]})
                columns = [[row["part"]] * len(steps), *zip(*steps)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    ship(counts.sparkSession)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *LABEL_COUNTS)).alias("counts"))
    return parts.mapInArrow(run, schema)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters by language."""
    return audit(failure_counts(docs, labels), "ABCD" + COPY)
