"""Fill-in-the-middle transformation, with cuts found through an indexable skip list.

A text is a sequence of units (a run of ASCII letters, or any other single code point).
Two cuts, drawn from a hash of the document's id, split it into prefix, middle and suffix,
which are written behind markers in one of two orders.  A share of the documents, empty
texts and texts that hold a marker stay plain.

The units of a text are the bottom lane of a skip list.  Each unit is promoted to the next
express lane with probability 1/``FAN`` (by a hash of its number, so reruns agree), and
every link of a lane carries two widths: the units and the code points that it skips.
Going down from the top lane and adding up widths reaches a unit's rank exactly, and the
sum of the other width is the code point at which to cut.

Each document is one row of an Arrow batch; there is no shuffle, and a task holds one batch.

Edge cases: a null text is empty, an empty text has no units and is plain; a null id is
hashed as an empty one; rows that repeat an id are cut by the same hashes; texts of any
length are taken whole (12 bytes a code point while their lanes stand); an empty table
gives an empty result; other columns are left out before any column is added.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, text_batches

FAN = 16
MARKERS = ("<P>", "<S>", "<M>")         # before prefix, suffix and middle
SEED = 1
CUT_PERCENT = 90                        # documents that are cut, the others stay plain
SPM_PERCENT = 20                        # cut documents whose suffix comes first
MIX = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def unit_widths(text: str) -> np.ndarray:
    """The code points of each unit of ``text``."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(0, np.int64)
    low = code | np.uint32(32)
    letter = (low >= 97) & (low <= 122)
    starts = ~letter
    starts[1:] |= starts[:-1]       # a letter behind something else starts a unit as well
    starts[0] = True
    return np.diff(np.append(np.flatnonzero(starts), len(code)))


class SkipList:
    """Lanes of links with two widths each; lane 0 holds every unit, the last lane the fewest."""

    def __init__(self, widths: np.ndarray, fan: int = FAN):
        self.n = len(widths)
        units, chars = np.ones(self.n, np.int64), widths
        self.lanes = [(units, chars, None)]
        number = np.arange(self.n, dtype=np.uint64)
        while len(units) > fan:
            number = (number ^ (number >> np.uint64(31))) * MIX + np.uint64(1)
            up = ((number >> np.uint64(40)) % np.uint64(fan)) == 0
            up[0] = True            # the head stands in every lane
            down = np.flatnonzero(up)
            if len(down) == len(units):
                break
            units, chars, number = np.add.reduceat(units, down), np.add.reduceat(chars, down), number[down]
            self.lanes.append((units, chars, down))

    def chars_before(self, rank: int) -> int:
        """The code points in front of unit ``rank`` (0 to n)."""
        at = skipped = chars = 0
        for units, widths, down in reversed(self.lanes):
            while at < len(units) and skipped + units[at] <= rank:
                skipped += int(units[at])
                chars += int(widths[at])
                at += 1
            if skipped == rank:
                return chars
            if down is not None:
                at = int(down[at])
        raise IndexError(rank)


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2**32 from the document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(doc_id, text: str | None, seed: int = SEED, markers=MARKERS,
              cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple:
    """(units, form, prefix's and middle's code points, output) of one document."""
    text = text or ""
    widths = unit_widths(text)
    n = len(widths)
    h = draws(doc_id, seed)
    if not n or h[2] % 100 >= cut_percent or any(m in text for m in markers):
        return n, "plain", None, None, text
    lanes = SkipList(widths)
    a, b = (lanes.chars_before(x) for x in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    pre, suf, mid = markers
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"{suf}{text[b:]}{pre}{text[:a]}{mid}{text[a:b]}"
    return n, "psm", a, b - a, f"{pre}{text[:a]}{suf}{text[b:]}{mid}{text[a:b]}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, markers=MARKERS, cut_percent: int = CUT_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (the text to train on) of every row of ``docs``."""
    def run(batches):
        import pyarrow as pa
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [transform(d, t, seed, markers, cut_percent, spm_percent)
                    for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            cols = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text_batches(rows).mapInArrow(run, SCHEMA)


def restored(form: Column, output: Column, markers=MARKERS) -> Column:
    """The text that ``output`` was made of; a cut text holds no marker, so its own three stand where it is to be split."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
