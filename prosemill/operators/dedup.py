"""Exact and fuzzy deduplication, set operations on keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosemill.session import ship


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest order of each key; rows without a key stay. Aggregated before the shuffle, so no key is hot."""
    keyed, rest = df.where(F.coalesce(F.col(key), F.lit("")) != ""), df.where(F.coalesce(F.col(key), F.lit("")) == "")
    first = keyed.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("__row")).select("__row.*")
    return first.unionByName(rest)


def exact_text_dedup(df: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of each text (null and empty texts are one text)."""
    return df.groupBy(F.coalesce(F.col(text), F.lit("")).alias("__k")).agg(F.min_by(F.struct(*df.columns), order).alias("__row")).select("__row.*")


def without_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known yet. The planner broadcasts known where it is small."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def numbered(df: DataFrame, order: str, name: str, checkpoint) -> DataFrame:
    """Adds a column of numbers from 0 without gaps, in the order of a column: ranges of it are sorted by themselves, and
    only the number of rows of each range is summed over all."""
    ranged = checkpoint(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id()))
    sizes = ranged.groupBy(F.shiftright("__at", 33).alias("__range")).agg(F.count("*").alias("__n"))
    # A row for each range.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    both = ranged.withColumn("__range", F.shiftright("__at", 33)).join(bases, "__range")
    return both.withColumn(name, F.col("__base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__range", "__base", "__at")


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: one big integer holds a row of the table."""
    if not a or not b:
        return 0
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & place.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 for equal strings, 0 without a common character: 200 * LCS / (len a + len b)."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


#: Blocks of places in a task, letters of a bag, characters of a text's beginning, its words of so many bits, codes of
#: characters (the last one is none), pairs handled at a time.
BLOCKS, LETTERS, BEGIN, WORDS, BITS, CODES, PAIRS = 8, b"abcdefghijklmnopqrstuvwxyz ", 192, 5, 62, 64, 1 << 12

#: Pairs of a range when stretches are told.
RANGE = 1_000_000


class _Band:
    """Rows of consecutive blocks of places with what bounds their ratios; all are upper bounds, so none loses a pair.

    Of two texts of lengths m and n, LCS is at most the shorter length, and at most what the bags of characters have in
    common. If LCS is L, all but n - L of the second text's first k characters are matched, and only to the first text's
    first k + m - L: so these beginnings have an LCS of at least k - (n - L). Characters that share a code can only make it longer.
    """

    def __init__(self, places: np.ndarray, texts: list[str], threshold: float):
        self.at, self.texts, self.threshold = places, texts, threshold
        self.n = np.array([len(t) for t in texts], np.int64)
        self.bag = np.zeros((len(texts), len(LETTERS) + 1), np.int32)
        self.codes = np.full((len(texts), BEGIN), CODES - 1, np.uint8)
        self.masks = np.zeros((WORDS, len(texts) * CODES), np.uint64)
        slot = np.full(256, len(LETTERS))
        slot[np.frombuffer(LETTERS, np.uint8)] = np.arange(len(LETTERS))
        for k, t in enumerate(texts):
            points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
            self.bag[k] = np.bincount(slot[np.minimum(points, 255)], minlength=len(LETTERS) + 1)
            codes = points[: WORDS * BITS] % (CODES - 1)
            self.codes[k, : len(codes)] = codes[:BEGIN]
            place = np.arange(len(codes))
            np.bitwise_or.at(self.masks, (place // BITS, k * CODES + codes), np.uint64(1) << (place % BITS).astype(np.uint64))

    def candidates(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all rows left with all rows right, those whose bounds reach the threshold."""
        total = self.n[left][:, None] + self.n[right]
        need = self.threshold * total / 200.0
        ok = (np.minimum(self.n[left][:, None], self.n[right]) >= need) & (self.n[left][:, None] > 0)
        common = np.zeros(ok.shape, np.int32)
        for c in range(self.bag.shape[1]):
            common += np.minimum(self.bag[left, c][:, None], self.bag[right, c])
        x, y = np.nonzero(ok & (common >= need))
        return left[x], right[y]

    def by_beginning(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs have beginnings alike enough: LCS in words of bits, of many pairs at once."""
        least = np.ceil(self.threshold * (self.n[i] + self.n[j]) / 200.0 - 1e-9).astype(np.int64)
        read = np.minimum(self.n[j], BEGIN)
        size = np.minimum(self.n[i], read + self.n[i] - least)
        need = read - (self.n[j] - least)
        # Where the first text's beginning doesn't fit the words, there is no bound.
        out = np.ones(len(i), bool)
        order = np.argsort(size, kind="stable")
        order = order[: np.searchsorted(size[order], WORDS * BITS, side="right")]
        full, top = np.uint64((1 << BITS) - 1), np.uint64(BITS)
        for k in range(0, len(order), PAIRS):
            of = order[k : k + PAIRS]
            base, codes = i[of] * CODES, np.ascontiguousarray(self.codes[j[of]].T)
            words = int(-(-size[of[-1]] // BITS))
            rows = [np.full(len(of), full) for _ in range(words)]
            for step in range(int(read[of].max())):
                at, carry = base + codes[step], np.uint64(0)
                for w in range(words):
                    hit = self.masks[w].take(at)
                    hit &= rows[w]
                    total = rows[w] + hit
                    total += carry
                    carry = total >> top
                    rows[w] ^= hit
                    rows[w] |= total
                    rows[w] &= full
            common = np.zeros(len(of), np.int64)
            for w, row in enumerate(rows):
                inside = (np.uint64(1) << np.clip(size[of] - w * BITS, 0, BITS).astype(np.uint64)) - np.uint64(1)
                common += np.bitwise_count(~row & inside)
            out[of] = common >= need[of]
        return out

    def pairs(self, own: int, ahead: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, ratio) of the first so many rows with those up to ahead places after each."""
        for a in range(0, own, 256):
            left = np.arange(a, min(own, a + 256))
            right = np.arange(a, np.searchsorted(self.at, self.at[left[-1]] + ahead, side="right"))
            i, j = self.candidates(left, right)
            near = (self.at[j] > self.at[i]) & (self.at[j] <= self.at[i] + ahead)
            i, j = i[near], j[near]
            near = self.by_beginning(i, j)
            i, j = i[near], j[near]
            ratio = np.array([100.0 if self.texts[x] == self.texts[y] else indel_ratio(self.texts[x], self.texts[y]) for x, y in zip(i.tolist(), j.tolist())], np.float64)
            yield self.at[i[ratio >= self.threshold]], self.at[j[ratio >= self.threshold]], ratio[ratio >= self.threshold]


def similar_pairs(df: DataFrame, text: str, order: str, threshold: float = 90.0, ahead: int = 999) -> DataFrame:
    """(i, j, ratio) of rows i < j within so many places of each other whose ratio reaches the threshold.

    order numbers the rows without gaps (a number that is there twice, or null, is an error of the caller's). A task
    takes BLOCKS blocks of ahead + 1 places and the block that follows, so a text moves once and an eighth, and groups are
    bounded by places whatever the texts are. Length, bags of characters and the texts' beginnings bound the ratio in turn; LCS
    is computed for what they let through. Null and empty texts have no pairs.
    """
    ship(df.sparkSession)
    width = (ahead + 1) * BLOCKS
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(F.col(order).cast("long").alias("i"), t.alias("t")).where("t <> ''")
    # The first ahead places of a task are also what the task before looks ahead to.
    group = F.expr(f"i div {width}")
    dealt = rows.select("i", "t", F.explode(F.when((F.col("i") % width < ahead) & (F.col("i") >= width), F.array(group, group - 1)).otherwise(F.array(group))).alias("band"))

    def of(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        band = _Band(table["i"].to_numpy(), table["t"].to_pylist(), threshold)
        own = int(np.searchsorted(band.at, (key[0].as_py() + 1) * width))
        found = list(band.pairs(own, ahead))
        join = lambda k, kind: np.concatenate([np.zeros(0, kind), *[f[k] for f in found]])
        return pa.table({"i": join(0, np.int64), "j": join(1, np.int64), "ratio": join(2, np.float64)})

    return dealt.groupBy("band").applyInArrow(of, "i long, j long, ratio double")


def _ranged(pairs: DataFrame, checkpoint) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Pairs in ranges of i, each sorted, with the range's number; of each range the largest j."""
    pairs = checkpoint(pairs.select("i", "j"))
    ranges = max(1, min(20_000, pairs.count() // RANGE))
    ranged = checkpoint(pairs.repartitionByRange(ranges, "i").sortWithinPartitions("i", "j").withColumn("range", F.spark_partition_id()))
    return ranged, [(r[0], r[1]) for r in ranged.groupBy("range").agg(F.max("j")).orderBy("range").collect()]


def stretches(pairs: DataFrame, checkpoint) -> DataFrame:
    """i, j and stretch: the smallest i of the stretch of places that the pair lies in. No pair reaches over the end of a stretch.

    A stretch begins at an i beyond all j before it. Ranges of i are looked at by themselves; only the largest j and the
    last beginning of each range meet.
    """
    ship(pairs.sparkSession)
    ranged, most = _ranged(pairs, checkpoint)
    reach, before = -1, {}
    for r, j in most:
        before[r], reach = reach, max(reach, j)

    def begin(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("i", "ascending"), ("j", "ascending")])
        i, j = table["i"].to_numpy(), table["j"].to_numpy()
        so_far = np.maximum.accumulate(np.concatenate([[before[key[0].as_py()]], j[:-1]]))
        starts = np.where(i > so_far, i, -1)
        return table.append_column("stretch", pa.array(np.maximum.accumulate(starts)))

    own = checkpoint(ranged.groupBy("range").applyInArrow(begin, "i long, j long, range int, stretch long"))
    last, open_ = -1, []
    for r, s in ((r[0], r[1]) for r in own.groupBy("range").agg(F.max("stretch")).orderBy("range").collect()):
        open_.append((r, last))
        last = max(last, s)
    bases = pairs.sparkSession.createDataFrame(open_, "range int, base long")
    return own.join(F.broadcast(bases), "range").select("i", "j", F.greatest("stretch", "base").alias("stretch"))


def greedy_kept(rows: DataFrame, pairs: DataFrame, order: str, checkpoint) -> DataFrame:
    """Rows that stay when, in order, each kept row drops the later rows it is paired with; a dropped row drops nothing.

    Pairs are split into stretches that no pair reaches out of; each is walked once in order, remembering only what is
    dropped ahead. So the jobs are the same in number whatever chains there are, and memory is that of the places
    that pairs reach over. The walk of one stretch is sequential, as its meaning is. checkpoint writes a frame and reads it back.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, dropped = None, set()
        for batch in batches:
            out, i = [], -1
            for s, i, j in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if s != stretch:
                    stretch, dropped = s, set()
                if i not in dropped and j not in dropped:
                    dropped.add(j)
                    out.append(j)
            dropped = {j for j in dropped if j >= i}
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["j"])

    found = stretches(pairs, checkpoint).select("stretch", "i", "j").repartition("stretch").sortWithinPartitions("stretch", "i", "j")
    dropped = checkpoint(found.mapInArrow(walk, "j long"))
    return rows.join(dropped.select(F.col("j").alias(order)), order, "left_anti")
