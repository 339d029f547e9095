"""Fill-in-middle transformation: cuts between units of a text, found by a table-driven automaton over its bytes.

The automaton reads UTF-8 once. Each transition says whether the byte starts a unit (a run of A-Z, a-z, or any other
character) and whether it ends a sentinel; a continuation byte starts nothing. The bytes of a batch lie in lanes of equal
length that step together, and the starts of each lane are counted. A second pass finds the n-th start of a text by the
counts, then inside one lane. After two bytes the state doesn't depend on where the automaton began, so a lane begins
two bytes early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import tune

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a lane, and places looked up at a time.
LANE, BLOCK = 512, 4096
#: Not a byte of UTF-8: stands between texts.
APART = 0xFF
#: States: after another character, after '<', after '<' and a letter of a sentinel, in a run of letters.
OTHER, OPEN, NAMED, RUN = range(4)
#: What a transition counts, beside the next state in the two lowest bits.
START, SENTINEL = 4, 8


def table() -> np.ndarray:
    """The next state and the counts of each state and byte, at 256 * state + byte."""
    out = np.zeros((4, 256), np.uint8)
    names = [ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]
    for byte in range(256):
        if chr(byte).isascii() and chr(byte).isalpha():
            for state in (OTHER, OPEN, NAMED, RUN):
                named = state == OPEN and byte in names
                out[state, byte] = (NAMED if named else RUN) | (START if state in (OTHER, OPEN) else 0)
        elif byte == APART or 0x80 <= byte < 0xC0:
            out[:, byte] = OTHER
        else:
            out[:, byte] = (OPEN if byte == ord("<") else OTHER) | START
    out[NAMED, ord(">")] |= SENTINEL
    return out.reshape(-1)


_TABLE = table()


class Scan:
    """One scan of texts laid side by side with APART after each: what each byte counts, and the starts of units by lane."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.begins = offsets[:-1] + np.arange(len(offsets) - 1)
        self.ends = offsets[1:] + np.arange(len(offsets) - 1)
        total = int(self.ends[-1]) + 1 if len(self.ends) else 0
        lanes = max(1, -(-total // LANE))
        flat = np.full(lanes * LANE + 2, APART, np.uint8)
        inside = np.ones(total, bool)
        inside[self.ends] = False
        flat[2 : total + 2][inside] = data
        state = np.zeros(lanes, np.uint16)
        for back in (0, 1):
            state = (_TABLE[(state << 8) | flat[back : lanes * LANE : LANE]] & 3).astype(np.uint16)
        steps = np.ascontiguousarray(flat[2:].reshape(lanes, LANE).T)
        for t in range(LANE):
            code = _TABLE[(state << 8) | steps[t]]
            steps[t] = code
            state = (code & 3).astype(np.uint16)
        self.codes = np.ascontiguousarray(steps.T)
        self.after = np.cumsum(np.count_nonzero(self.codes & START, axis=1))
        self.before = np.concatenate([[0], self.after[:-1]])

    def units_before(self, places: np.ndarray) -> np.ndarray:
        """Units that start before each place."""
        out = self.before[np.minimum(places // LANE, len(self.before) - 1)].copy()
        for a in range(0, len(places), BLOCK):
            own = places[a : a + BLOCK]
            part = (self.codes[own // LANE] & START > 0) & (np.arange(LANE) < (own % LANE)[:, None])
            out[a : a + BLOCK] += np.count_nonzero(part, axis=1)
        return out

    def starts(self, units: np.ndarray) -> np.ndarray:
        """The place where each unit starts, counted over all texts."""
        lane = np.searchsorted(self.after, units, side="right")
        out = np.empty(len(units), np.int64)
        for a in range(0, len(units), BLOCK):
            own = lane[a : a + BLOCK]
            counted = np.cumsum(self.codes[own] & START > 0, axis=1, dtype=np.int32)
            out[a : a + BLOCK] = own * LANE + np.argmax(counted > (units[a : a + BLOCK] - self.before[own])[:, None], axis=1)
        return out

    def marked(self) -> np.ndarray:
        """Texts that hold a sentinel."""
        at = np.flatnonzero(self.codes.reshape(-1) & SENTINEL)
        return np.unique(np.searchsorted(self.ends, at))


def _form(batch: pa.RecordBatch, plain: int, spm: int) -> pa.RecordBatch:
    data, offsets = A.buffers(batch.column(1))
    h1, h2, h3, h4 = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
    scan = Scan(data, offsets)
    first = scan.units_before(scan.begins)
    n = scan.units_before(scan.ends) - first
    is_plain = (n == 0) | (h3 % 100 >= plain)
    is_plain[scan.marked()] = True
    # Second pass: the two cuts, as places in a text.
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
    at = []
    for k in cuts:
        place = np.diff(offsets)
        inner = np.flatnonzero(k < n)
        place[inner] = scan.starts(first[inner] + k[inner]) - scan.begins[inner]
        at.append(place)
    raw, forms, outputs, sizes = data.tobytes(), [], [], []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for i, (begin, end, a, b, whole, last) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), at[0].tolist(), at[1].tolist(), is_plain.tolist(), (h4 % 100 < spm).tolist())):
        if whole:
            forms.append("plain"), outputs.append(raw[begin:end]), sizes.append((None, None))
            continue
        prefix, middle, suffix = raw[begin : begin + a], raw[begin + a : begin + b], raw[begin + b : end]
        forms.append("spm" if last else "psm")
        outputs.append(b"".join((s, suffix, p, prefix, m, middle) if last else (p, prefix, s, suffix, m, middle)))
        sizes.append((len(prefix.decode("utf-8", "replace")), len(middle.decode("utf-8", "replace"))))
    columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(forms), *[pa.array([x[i] for x in sizes], pa.int64()) for i in (0, 1)], pa.array(outputs, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: int = 1, formed_pct: int = 90, spm_pct: int = 20) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output, for every document.

    Where the cuts are and which form is taken follow from the seed and the doc_id alone; rows of one doc_id are
    cut alike, a null doc_id counts as an empty one. Null texts are empty. Empty texts and texts with a sentinel in them
    stay as they are (plain), as do all but formed_pct in 100. Other columns are ignored; an empty table gives no rows.
    """
    tune(docs.sparkSession, 3)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *h)

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _form(batch, formed_pct, spm_pct)
            A.trim()

    return own.mapInArrow(form, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts with sentinels are plain, so each mark is there once."""
    part = lambda s, mark, i: F.split_part(s, F.lit(mark), F.lit(i))
    tail, middle = part(output, MIDDLE, 1), part(output, MIDDLE, 2)
    psm = F.concat(part(part(tail, PREFIX, 2), SUFFIX, 1), middle, part(tail, SUFFIX, 2))
    spm = F.concat(part(tail, PREFIX, 2), middle, part(part(tail, PREFIX, 1), SUFFIX, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(formed: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the SHA-256 of the output and of the text rebuilt from it."""
    back = restored(F.col("output"), F.col("form"))
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
