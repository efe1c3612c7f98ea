"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The library's own normaliser (space marks, dummy prefix) prepares the text.  Its symbols
start as characters; an agenda holds every adjacent pair whose joined text is a piece,
ordered by score and then by place from the left; the best pair is joined, its two new
neighbours enter the agenda, and entries that name joined-away symbols are skipped.
Symbols outside the vocabulary fall back to their UTF-8 bytes.

No piece holds a space mark after another character, and none holds a line feed (checked
when the model is loaded), so merges never cross these places: a text is encoded segment by
segment, and equal segments once per batch.  Every newly met segment is checked against
the sentencepiece library in the Arrow batch that brings it; a difference ends the job.

Defined results: a null text counts as empty (only the end id, decoded as empty); whole
texts of any length; equal rows give equal results.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ListMemo, broadcast_file, chunks, id_lists, per_worker, text_udf, whole_text

MARK = "▁"
FIELDS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


class PieceModel:
    """Encoder and decoder for one model file (as bytes)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        normal = [i for i in range(lib.get_piece_size())
                  if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in normal}
        self.rank = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        crossing = re.compile(f"[^{MARK}]{MARK}|.\\n|\\n.", re.S)
        # segments are spelt with spaces for marks: shorter strings to keep
        self.segment = re.compile(".+" if any(map(crossing.search, self.ids)) else " *[^ \n]+| +|\n", re.S)
        self.said = [str(i) for i in range(lib.get_piece_size())]
        self.pairs = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.closers = {c for c in ".,!?;:" if c in self.ids}
        self.memo = ListMemo(self._encode_segments, limit=150_000)

    def merge(self, text: str) -> list[str]:
        """The pieces of one segment, by the agenda: a list in text order while it is
        short enough to be searched for its best pair, else a heap."""
        if len(text) > 32:
            return self.merge_long(text)
        rank, far, symbols = self.rank.get, float("inf"), list(text)
        agenda = [rank(a + b, far) for a, b in zip(text, text[1:])]
        while agenda and (best := min(agenda)) < far:
            i = agenda.index(best)
            joined = symbols[i] + symbols[i + 1]
            symbols[i:i + 2] = [joined]
            del agenda[i]
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + joined, far)
            if i < len(agenda):
                agenda[i] = rank(joined + symbols[i + 1], far)
        return symbols

    def merge_long(self, text: str) -> list[str]:
        symbols, rank, n = list(text), self.rank, len(text)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in rank:
                agenda.append((rank[joined], i, joined))
        heapq.heapify(agenda)

        def offer(i: int, joined: str) -> None:
            if joined in rank:
                heapq.heappush(agenda, (rank[joined], i, joined))

        while agenda:
            _, i, joined = heapq.heappop(agenda)
            j = right[i]
            # symbols[i] is "" once it was joined to its left neighbour
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j], right[i] = joined, "", right[j]
            if right[i] < n:
                left[right[i]] = i
                offer(i, joined + symbols[right[i]])
            if left[i] >= 0:
                offer(left[i], symbols[left[i]] + joined)
        return [s for s in symbols if s]

    def piece_ids(self, pieces: list[str]) -> tuple[int, ...]:
        found = tuple(map(self.ids.get, pieces))
        if None not in found:
            return found
        return tuple(chain.from_iterable([i] if i is not None else [self.bytes[b] for b in p.encode("utf-8")]
                                         for p, i in zip(pieces, found)))

    def _encode_segments(self, segments: list[str]) -> pa.ListArray:
        """Ids of each segment."""
        # a last character that joins no piece with the one before it stands alone
        stems = [s[:-1] if s[-1] in self.closers and s[-2:].replace(" ", MARK) not in self.pairs else None for s in segments]
        known = iter(self.memo.peek(pa.array([s for s in stems if s], pa.string())).to_pylist())
        found = []
        for s, stem in zip(segments, stems):
            ids = next(known) if stem else None
            ids = self.piece_ids(self.merge(s.replace(" ", MARK))) if ids is None else [*ids, self.ids[s[-1]]]
            found.append(struct.pack(f"<{len(ids)}i", *ids))
        self.check(segments, found)
        return id_lists(np.frombuffer(b"".join(found), "<i4"), [len(x) >> 2 for x in found])

    def check(self, segments: list[str], found: list[bytes]) -> None:
        """The library on the same segments: it adds one mark in front itself, so one
        that starts otherwise (after a line feed) is checked behind a line feed."""
        texts = [s[1:] if s[0] == " " else "\n" + s for s in segments]
        lead = len(self.library.encode("\n"))
        for s, ids, own in zip(segments, self.library.encode(texts, num_threads=1), found):
            if s[0] != " ":
                ids = ids[lead:]
            if struct.pack(f"<{len(ids)}i", *ids) != own and s != " ":
                raise ValueError(f"pieces of {s!r} differ from the sentencepiece library")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.segment.findall(x.replace(MARK, " ")) for x in self.library.normalize(texts)]
        segments = pa.array(list(chain.from_iterable(split)), pa.string()).dictionary_encode()
        found = self.memo.look(segments.dictionary).take(segments.indices)
        bounds, ids = np.append(0, np.cumsum([len(x) for x in split])), found.values.to_numpy()
        ends = found.offsets.to_numpy()[bounds].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


def round_trips(model: PieceModel, encoded: list[np.ndarray]) -> list[tuple[int, str, str]]:
    """Per encoded text, with an end id: ids, sha256 of the ids, sha256 of the decoded text."""
    end, said = model.library.eos_id(), model.said.__getitem__
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    out = []
    for at in range(0, len(encoded), 256):  # as Python numbers, ids take much more memory
        found = [[*ids.tolist(), end] for ids in encoded[at:at + 256]]
        out += [(len(ids), sha(" ".join(map(said, ids))), sha(back)) for ids, back in zip(found, model.decode(found))]
    return out


def encode_documents(docs: DataFrame, model: str, carry: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, the columns to ``carry`` and, if asked
    for, the ids with the end id, of every row; no shuffle."""
    held = broadcast_file(docs.sparkSession, model)

    def setup():
        own = per_worker(PieceModel, held.value)
        return lambda texts: round_trips(own, own.encode(texts))

    def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = per_worker(PieceModel, held.value)
        for batch in batches:
            at = 0
            for part in chunks(batch.column("text"), rows=2048, nbytes=2 << 20):
                encoded = own.encode(part.to_pylist())
                ids = [np.append(x, own.library.eos_id()).astype(np.int32) for x in encoded]
                made = [pa.array(x) for x in zip(*round_trips(own, encoded))]
                kept = [batch.column(c).slice(at, len(part)) for c in ("doc_id", *carry)]
                yield pa.RecordBatch.from_arrays([kept[0], *made, *kept[1:], id_lists(np.concatenate(ids), map(len, ids))],
                                                 names=["doc_id", *FIELDS, *carry, "ids"])
                at += len(part)

    if with_ids:
        kinds = {"doc_id": docs.schema["doc_id"].dataType.simpleString()} | FIELDS | {c: docs.schema[c].dataType.simpleString() for c in carry}
        return docs.select("doc_id", *carry, whole_text().alias("text")).mapInArrow(encoded_rows, ", ".join(f"{k} {t}" for k, t in kinds.items()) + ", ids array<int>")
    made = text_udf(setup, FIELDS, rows=2048, nbytes=2 << 20)(whole_text()).alias("__r")
    return docs.select("doc_id", *carry, made).select("doc_id", "__r.*", *carry)
