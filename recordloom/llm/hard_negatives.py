"""Hard negatives by threshold joins over inverted indexes with norm bounds.

Anchors and rows meet in cells of a grid: rows are dealt to some groups, anchors to others, by hash, and every cell has a
bounded part of both. In a cell, rows are indexed block by block. Dimensions go by energy, the greatest first, in
stretches; each stretch has the list of the rows that it indexes, with their components there. A row leaves out its
last dimensions as soon as their norm, times the greatest norm of an anchor, is below the threshold: pairs that only
meet there cannot reach it. A search accumulates scores stretch by stretch, drops pairs whose score and remaining norms
(Cauchy-Schwarz) stay below the anchor's threshold, and completes those that are left. Thresholds begin high
and are lowered, for the anchors whose windows are not full, down to the least score that counts; what earlier blocks found raises
them for later ones. Results are exact. Components are integers; scores stay integers in double precision while
they are below 2^53, and are added as 64-bit integers otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

#: Greatest mean sizes of a cell, rows of a block, and stretches of dimensions of an index.
ROWS_A_CELL, ANCHORS_A_CELL, BLOCK, STRETCHES = 4096, 1024, 2048, 8
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "anchor_id long, slot int, other_id long, score long"


def matrix(column: pa.ChunkedArray, dims: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), max(dims, int(sizes.max(initial=0)))), dtype=np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Index:
    """An inverted index of some rows, for thresholds of ``least`` or more and anchors of norm ``widest`` or less."""

    def __init__(self, rows: np.ndarray, least: float, widest: float):
        self.order = np.argsort(-np.square(rows.astype(float)).sum(axis=0), kind="stable")
        self.rows = rows[:, self.order]
        step = max(1, -(-rows.shape[1] // STRETCHES))
        self.cuts = [(d, min(d + step, rows.shape[1])) for d in range(0, rows.shape[1], step)]
        self.rest = remaining(self.rows, self.cuts)
        self.lists = []
        for c, (start, stop) in enumerate(self.cuts):
            before = self.rest[c - 1] if c else np.sqrt(np.square(self.rows.astype(float)).sum(axis=1))
            held = np.flatnonzero(slack(before * widest) >= least)
            self.lists.append((held, self.rows[held, start:stop]))

    def search(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs at or above the anchor's threshold."""
        anchors = anchors[:, self.order]
        rest = remaining(anchors, self.cuts)
        alive = np.arange(len(self.rows))
        partial = np.zeros((len(anchors), len(alive)), dtype=self.rows.dtype)
        for c, (start, stop) in enumerate(self.cuts):
            held, parts = self.lists[c]
            places = np.searchsorted(held, alive)
            known = places < len(held)
            known[known] = held[places[known]] == alive[known]
            if not known.all():  # rows that leave this stretch out are completed at the end, if they can still count
                break
            partial += anchors[:, start:stop] @ parts[places].T
            reach = slack(partial + rest[c][:, None] * self.rest[c][alive][None, :]) >= thresholds[:, None]
            keep = reach.any(axis=0)
            if not keep.all():
                alive, partial = alive[keep], partial[:, keep]
            if not len(alive):
                break
            done = stop
        else:
            at, row = np.nonzero(partial >= thresholds[:, None])
            return at, alive[row], partial[at, row].astype(np.int64)
        if not len(alive):
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        done = self.cuts[c - 1][1] if c else 0
        at, row = self._candidates(partial, rest, alive, c, thresholds)
        score = partial[at, row].astype(self.rows.dtype)
        for i in range(0, len(at), 1 << 16):
            s = slice(i, i + (1 << 16))
            score[s] += (anchors[at[s], done:] * self.rows[alive[row[s]], done:]).sum(axis=1)
        keep = score >= thresholds[at]
        return at[keep], alive[row[keep]], score[keep].astype(np.int64)

    def _candidates(self, partial: np.ndarray, rest: list[np.ndarray], alive: np.ndarray, c: int, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that can still count, with ``c`` stretches accumulated."""
        if c:
            return np.nonzero(slack(partial + rest[c - 1][:, None] * self.rest[c - 1][alive][None, :]) >= thresholds[:, None])
        return np.nonzero(np.ones(partial.shape, dtype=bool))


def remaining(vectors: np.ndarray, cuts: list[tuple[int, int]]) -> list[np.ndarray]:
    """Norms of what follows each stretch."""
    squares = np.square(vectors.astype(float))
    return [np.sqrt(squares[:, stop:].sum(axis=1)) for _, stop in cuts]


def slack(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding."""
    return bound + 1e-9 * np.abs(bound) + 1e-6


def best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` pairs of each anchor: higher scores first, then smaller identifiers."""
    order = np.lexsort((ids, -scores, at))
    ordered = at[order]
    first = np.searchsorted(ordered, ordered)
    return order[np.arange(len(order)) - first < most]


class Windows:
    """Searches one cell: for each anchor some windows of scores, in each the best ``most`` rows."""

    def __init__(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, most: int):
        self.anchors, self.low, self.high, self.most = anchors, low, high, most
        none = np.empty(0, dtype=np.int64)
        self.found = [(none, none, none) for _ in range(low.shape[1])]
        self.norms = np.sqrt(np.square(anchors.astype(float)).sum(axis=1))
        self.least = low.min(axis=1, initial=np.inf)

    def _needed(self) -> np.ndarray:
        """The score that an anchor's next row must reach to enter a window: that of its last one where all are full."""
        needed = np.full(len(self.anchors), np.inf)
        for slot, (at, _, scores) in enumerate(self.found):
            last = np.full(len(self.anchors), np.inf)
            np.minimum.at(last, at, scores)
            full = np.bincount(at, minlength=len(self.anchors)) >= self.most
            needed = np.minimum(needed, np.where(full, last, self.low[:, slot]))
        return needed

    def add(self, ids: np.ndarray, rows: np.ndarray, allowed) -> None:
        """Search a block of rows. ``allowed(at, row)`` says which pairs count."""
        widest = self.norms.max(initial=0)
        longest = np.sqrt(np.square(rows.astype(float)).sum(axis=1)).max(initial=0)
        top = np.minimum(self.norms * longest, self.high.max(axis=1, initial=-np.inf))
        open_ = np.flatnonzero(self._needed() <= slack(self.norms * longest))
        for share in (0.8, 0.5, 0.0):
            if not len(open_):
                return
            needed = self._needed()[open_]
            thresholds = np.maximum(needed, top[open_] * share) if share else needed
            index = Index(rows, float(thresholds.min()), widest)
            at, row, scores = index.search(self.anchors[open_], thresholds)
            at = open_[at]
            keep = allowed(at, row)
            self._take(at[keep], ids[row[keep]], scores[keep])
            open_ = open_[self._needed()[open_] < thresholds]

    def _take(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        for slot, known in enumerate(self.found):
            inside = (scores >= self.low[at, slot]) & (scores <= self.high[at, slot])
            new = [np.concatenate(pair) for pair in zip(known, (at[inside], ids[inside], scores[inside]), strict=True)]
            _, once = np.unique(np.stack(new[:2]), axis=1, return_index=True)  # lowered thresholds find pairs again
            new = [column[once] for column in new]
            chosen = best(*new, self.most)
            self.found[slot] = tuple(column[chosen] for column in new)

    def rows(self, anchor_ids: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for slot, (at, ids, scores) in enumerate(self.found):
            yield anchor_ids[at], np.full(len(at), slot, dtype=np.int32), ids, scores


def _result(parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["anchor_id", "slot", "other_id", "score"])


def _loaded(anchors: pa.Table, rows: pa.Table) -> tuple:
    """Identifiers, labels and vectors of both sides, in a type that adds scores exactly."""
    dims = max(matrix(anchors["anchor_vector"]).shape[1], 1)
    y = matrix(rows["vector"], dims)
    x = matrix(anchors["anchor_vector"], y.shape[1])
    limit = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(y.astype(float)).max(initial=0)) * y.shape[1]
    kind = np.float64 if limit < 2**53 else np.int64
    plain = [anchors["anchor_id"], rows["vec_id"], anchors["anchor_label"], rows["label"]]
    return *(c.to_numpy() for c in plain), x.astype(kind), y.astype(kind)


def _positives(most: int, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    if not anchors.num_rows or not rows.num_rows:
        return _result([])
    anchor_ids, row_ids, anchor_labels, row_labels, x, y = _loaded(anchors, rows)
    parts = []
    for label in np.unique(anchor_labels):
        mine, theirs = np.flatnonzero(anchor_labels == label), np.flatnonzero(row_labels == label)
        unbounded = np.full((len(mine), 1), np.inf)
        search = Windows(x[mine], -unbounded, unbounded, most)
        for i in range(0, len(theirs), BLOCK):
            block = theirs[i : i + BLOCK]
            search.add(row_ids[block], y[block], lambda at, row, mine=mine, block=block: anchor_ids[mine[at]] != row_ids[block[row]])
        parts += search.rows(anchor_ids[mine])
    return _result(parts)


def _negatives(most: int, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    if not anchors.num_rows or not rows.num_rows:
        return _result([])
    anchor_ids, row_ids, anchor_labels, row_labels, x, y = _loaded(anchors, rows)
    scores = anchors["scores"].to_pylist()
    low, high = (np.full((len(scores), max(map(len, scores))), side) for side in (np.inf, -np.inf))
    for i, own in enumerate(scores):
        for slot, p in enumerate(own):
            if p >= 0:  # below, no score is between a half and 95 hundredths
                low[i, slot], high[i, slot] = (p + 1) // 2, 95 * p // 100
    search = Windows(x, low, high, most)
    for i in range(0, len(row_ids), BLOCK):
        labels = row_labels[i : i + BLOCK]
        search.add(row_ids[i : i + BLOCK], y[i : i + BLOCK], lambda at, row, labels=labels: anchor_labels[at] != labels[row])
    return _result(list(search.rows(anchor_ids)))


def _grid(anchors: DataFrame, rows: DataFrame, groups: int, anchor_groups: int, search) -> DataFrame:
    """Every anchor with every row, in cells: a row goes to one cell per group of anchors, an anchor to one per group of rows."""

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.select("*", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(anchor_groups)).cast("int").alias("anchor_cell")).select("*", every(groups).alias("row_cell"))
    right = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("row_cell")).select("*", every(anchor_groups).alias("anchor_cell"))
    cell = ["anchor_cell", "row_cell"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, FOUND)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector of integers, of the rows that take part.

    Rows without a vec_id, label or vector, or with a component that is null or not finite, are left out. Of rows that repeat a
    vec_id the one of the smallest vector, then label, counts. Other columns are ignored.
    """
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * 256)).alias("vector"), F.col("label").cast("long").alias("label"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    return one.select("vec_id", F.col("row.label").alias("label"), F.col("row.vector").alias("vector"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, rows_a_cell: int = ROWS_A_CELL, anchors_a_cell: int = ANCHORS_A_CELL) -> DataFrame:
    """Hard negatives of each anchor and positive.

    ``rows`` has vec_id, label and vector as ``usable`` gives them. An anchor's positives are its best other rows of the
    same label; for each, the best rows of other labels with scores from 50 to 95 hundredths of the positive's are returned, with their rank.
    Ties go to the smaller vec_id; shorter vectors end in zeros. An anchor without positives, a positive with a negative score and a
    window without rows give nothing, and so does an empty table.
    """
    at = Scratch(rows.sparkSession, "hard-negatives")
    rows = at.save(rows, "rows")
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("vector").alias("anchor_vector"))
    groups, anchor_groups = (max(1, math.ceil(t.count() / size)) for t, size in ((rows, rows_a_cell), (anchors, anchors_a_cell)))
    found = _grid(anchors, rows, groups, anchor_groups, lambda a, r: _positives(positives, a, r))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    chosen = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    of_anchor = at.save(
        chosen.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "other_id", "score"))).alias("own"))
        .select("anchor_id", F.col("own.other_id").alias("ids"), F.col("own.score").alias("scores")), "positives"
    )
    with_scores = anchors.join(of_anchor.select("anchor_id", "scores"), "anchor_id")
    found = _grid(with_scores, rows, groups, anchor_groups, lambda a, r: _negatives(negatives, a, r))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = ranked.join(of_anchor, "anchor_id")
    slot = F.col("slot") + 1
    return named.select(
        "anchor_id", F.element_at("ids", slot).alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
        F.element_at("scores", slot).alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same, list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""
