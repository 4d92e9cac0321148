"""SentencePiece encoding and decoding over a table of distinct chunks.

The model marks each space with U+2581 and puts one mark before the text.  No
piece holds a mark behind another character, so no merge crosses the start of a
run of marks: a text is a sequence of chunks (marks, then other characters)
that are segmented independently.  Each task keeps a table of the chunks it has
met; a chunk is segmented once with the library, the new ones of some hundred
texts in one call, and texts are assembled by looking their chunks up in order.
The table lives in the worker and starts anew when it holds ``TABLE_CHARS``
characters, so memory is bounded; very long chunks are not kept.

A global table would move every word of the corpus through a shuffle (several
times the input); tables per task segment a frequent word once in each task.

``check_model`` refuses models for which chunks are not independent.

Edge cases: null text counts as empty; an empty text has the end id alone and
decodes to an empty text; repeated rows are encoded alike; null ids are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame

from .common import pick, text_batches

MARK = "▁"
TABLE_CHARS = 12 << 20
LONG_CHUNK = 256
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")
ROWS_A_BATCH = 512

SCHEMA = "doc_id bigint, ids array<int>, decoded string"
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def check_model(sp) -> None:
    """Raise unless the model's chunks are independent of each other."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(sp.serialized_model_proto())
    norm = proto.normalizer_spec
    crossing = [p.piece for p in proto.pieces if MARK in p.piece.lstrip(MARK)]
    user = [p.piece for p in proto.pieces if p.type == p.USER_DEFINED]
    if (crossing or user or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix or proto.trainer_spec.treat_whitespace_as_suffix):
        raise ValueError("pieces of this model may cross white space marks; chunks can't be segmented apart")


class ChunkTable:
    """Distinct chunk -> (number of ids, ids as text, decoded text with its leading space)."""

    def __init__(self, model: bytes | str):
        import sentencepiece
        self.sp = (sentencepiece.SentencePieceProcessor(model_proto=model) if isinstance(model, bytes)
                   else sentencepiece.SentencePieceProcessor(model_file=model))
        check_model(self.sp)
        self.end = self.sp.eos_id()
        self.lone = self.sp.piece_to_id(MARK)
        # what the library's decoder makes of each id behind another one: spaces for marks, raw
        # bytes for byte pieces, nothing for control pieces
        self.pieces = [
            b"" if self.sp.is_control(i) else bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(map(self.sp.id_to_piece, range(self.sp.get_piece_size())))]
        self.names = [f" {i}" for i in range(len(self.pieces))]
        self.new: list[str] = []
        self.known: dict[str, tuple[int, str, str]] = {}
        self.chars = 0

    def learn(self, chunks: Iterable[str]) -> None:
        """Segment those of ``chunks`` that the table doesn't hold, in one call of the library."""
        if self.chars > TABLE_CHARS:
            self.known.clear()
            self.chars = 0
        new = self.new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if not new:
            return
        # of a lone mark the library drops the mark, as it does for an empty text
        ids = [x or [self.lone] for x in self.sp.encode([c[1:].replace(MARK, " ") for c in new], num_threads=1)]
        known, piece, name = self.known, self.pieces, self.names
        for c, x in zip(new, ids):
            known[c] = (len(x), "".join([name[i] for i in x]), b"".join([piece[i] for i in x]).decode("utf-8", "replace"))
        self.chars += sum(map(len, new)) * 8 + 64 * len(new)

    def encode_all(self, texts: list[str | None]) -> list[list[tuple[int, str, str]]]:
        """Each text as the table's entries of its chunks, in order."""
        cut = [CHUNKS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(chain.from_iterable(cut))
        known = self.known
        out = [[known[c] for c in chunks] for chunks in cut]
        for c in [c for c in self.new if len(c) > LONG_CHUNK]:
            del known[c]
        return out

    def encode(self, text: str | None) -> list[tuple[int, str, str]]:
        return self.encode_all([text])[0]

    def ids(self, parts) -> list[int]:
        return [int(i) for p in parts for i in p[1].split()] + [self.end]

    @staticmethod
    def decoded(parts) -> str:
        return "".join([p[2] for p in parts])[1:]

    def digest(self, parts) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids as text and of the decoded text."""
        ids = ("".join([p[1] for p in parts]) + f" {self.end}")[1:]
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return sum([p[0] for p in parts]) + 1, sha(ids), sha(self.decoded(parts))


_TABLES: dict[str, ChunkTable] = {}


def _table(model: str) -> ChunkTable:
    if model not in _TABLES:
        _TABLES[model] = ChunkTable(model)
    return _TABLES[model]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (end id included) and decoded text; ``model`` is the vocabulary's path on every node."""
    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        table = _table(model)
        for b in batches:
            for at in range(0, len(b), ROWS_A_BATCH):
                part = b.iloc[at:at + ROWS_A_BATCH]
                entries = table.encode_all([None if pd.isna(t) else t for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").to_numpy(), "ids": [table.ids(p) for p in entries],
                                    "decoded": [table.decoded(p) for p in entries]})
    return text_batches(pick(docs, "doc_id", "text")).mapInPandas(run, SCHEMA)


def encode_digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode`` with its results as digests."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table = _table(model)
        for b in batches:
            texts = b.column("text").to_pylist()
            got = [table.digest(p) for at in range(0, len(texts), ROWS_A_BATCH)
                   for p in table.encode_all(texts[at:at + ROWS_A_BATCH])]
            n, ids, dec = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return text_batches(pick(docs, "doc_id", "text")).mapInArrow(run, DIGEST)
