"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A text becomes `▁` + text with spaces as `▁`. It is cut before each `▁` that follows another character and around
line ends and tabs, where no piece of the model can reach across (checked when the model is read); each part is
encoded by itself:

* an Aho-Corasick automaton over all pieces gives the longest piece that starts at each position,
* from left to right, the longest piece is tried that is compatible with the one before it and does not end at a
  position known to fail; else the next shorter one; else the position is marked in a bitfield and the last piece
  is taken back,
* two neighbours are compatible if merging their characters anew gives just these two; answers are remembered.

Characters that no piece covers become their UTF-8 bytes. Parts are remembered up to a bound within a partition.

Defined results: a null text counts as empty; an empty text has no ids and decodes to the empty text; other columns
are left alone; equal rows give equal rows; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import map_arrow

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MEMORY = 300_000


class PieceModel:
    """Encoder and decoder for a BPE model with byte fallback, no normalisation and a dummy prefix."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if spec.model_type != 2 or not spec.byte_fallback or spec.treat_whitespace_as_suffix or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} \
                or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no other normalisation are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        long = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in long):
            raise ValueError("a piece holds a space inside; parts of a text are not independent")
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in long))
        self.parts = re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        # A piece that its own characters do not merge into never comes out of merging.
        reached = [p for p in self.ids if len(p) == 1 or self.merge(list(p)) == [p]]
        self.shorter: dict[str, str | None] = {}
        known = set(reached)
        for p in reached:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None)
        self.automaton = ahocorasick.Automaton()
        for p in reached:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain merging: again and again the best-scored neighbouring pair, the leftmost of equals."""
        score = self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            answer = self.pairs[left, right] = self.merge(list(left + right)) == [left, right]
        return answer

    def backtrack(self, part: str) -> list[str]:
        n = len(part)
        longest: list[str | None] = [None] * n
        for end, piece in self.automaton.iter(part):
            longest[end - len(piece) + 1] = piece  # later ends are longer
        failed = bytearray(n + 1)
        taken: list[str] = []
        at = 0
        piece = longest[0] or part[0]
        while at < n:
            end = at + len(piece)
            if not failed[end] and (not taken or self.compatible(taken[-1], piece)):
                taken.append(piece)
                at = end
                if at < n:
                    piece = longest[at] or part[at]
                continue
            shorter = self.shorter.get(piece)
            if shorter is not None:
                piece = shorter
                continue
            failed[at] = 1
            if not taken:
                raise ValueError(f"no segmentation of {part[:80]!r}")
            piece = taken.pop()
            at -= len(piece)
        return taken

    def encode_part(self, part: str) -> bytes:
        """Ids of a part as little-endian int32; its decoded text is held apart if it is not the part itself."""
        ids: list[int] = []
        for piece in self.backtrack(part):
            known = self.ids.get(piece)
            ids += [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]
        decoded = self.decode_ids(ids)
        if decoded != part.replace(SPACE, " "):
            self.changed[part] = decoded
        return np.array(ids, "<i4").tobytes()

    def encode(self, text: str) -> tuple[int, bytes, str]:
        """Number of ids, ids as little-endian int32, the text decoded from them."""
        if not text:
            return 0, b"", ""
        memory, got = self.memory, []
        if len(memory) > MEMORY:
            self.forget()
        parts = self.parts(SPACE + text.replace(" ", SPACE))
        for part in parts:
            found = memory.get(part)
            if found is None:
                found = self.encode_part(part)
                if len(part) <= 64:
                    memory[part] = found
            got.append(found)
        raw = b"".join(got)
        # A part decodes to itself, with its spaces, unless it is held in `changed`.
        changed = self.changed
        decoded = ("".join([changed.get(p, p) for p in parts]) if changed else "".join(parts)).replace(SPACE, " ")
        return len(raw) // 4, raw, decoded[1:] if decoded.startswith(" ") else decoded

    def forget(self) -> None:
        self.memory.clear()
        self.changed.clear()

    def decode_ids(self, ids) -> str:
        """Text of ids in which every run of byte pieces holds whole or broken UTF-8; no leading space is dropped."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.bytes_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)


_MODELS: dict[int, PieceModel] = {}


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), decoded. The model file (under 1 MB) is read on the driver and sent along."""
    with open(model_file, "rb") as file:
        model = file.read()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(model)
        if key not in _MODELS:
            _MODELS[key] = PieceModel(model)  # once per Python worker
        encode = _MODELS[key].encode
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                counts, ids, decoded = [], [], []
                for text in batch.column(1).to_pylist():
                    n, raw, back = encode(text or "")
                    counts.append(n)
                    ids.append(raw)
                    decoded.append(back)
                offsets = np.zeros(len(counts) + 1, "i4")
                np.cumsum(counts, out=offsets[1:])
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])
        _MODELS[key].forget()  # the worker is used again by other stages
        _MODELS[key].pairs.clear()

    return map_arrow(docs.select("doc_id", F.col("text")), run, f"doc_id {id_type}, n_tokens bigint, ids array<int>, decoded string")
