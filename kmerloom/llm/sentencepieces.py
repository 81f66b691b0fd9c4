"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi search.

The automaton reads a text once. At each position its output links give every piece that ends there, longest first; each
relaxes the position's best segmentation. What a relaxation compares is the model's own rule, so that the ids are those of
the public library:

* unigram models: the best sum of piece scores; of equal sums, the one with the longest last pieces (where the library,
  adding in single precision, may take another of them).
* BPE models: a segmentation is what merging gives exactly if every two neighbouring pieces are what merging the two
  alone gives, for merges on either side of a border that none crosses do not depend on each other. A piece therefore
  relaxes a position only if it may follow the last piece of the best segmentation before it. One piece passes.

A character that no piece covers becomes its bytes' pieces. White space is written with U+2581 and a text gets one in
front, as the model file asks; a U+2581 that the text itself holds becomes bytes, so that decoding gives back every text
exactly (the library reads it as white space).

No piece of such a model goes on past a word: where U+2581 follows another character, a piece ends. Texts are therefore
cut there, and a word's ids are kept in a memo of bounded bytes, large enough for the words of a task of common size, so that
a word is segmented once. A model with pieces across words is read text by text.

Defined cases: a null text has no ids and decodes to null; an empty text has no ids; repeated rows are encoded alike; a
very long text is read whole; other columns are not read, whatever their names, except that ``decode_ids`` replaces a
column ``text``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
FIRST = 1 << 19
BPE = 2
MEMO_BYTES = 144 << 20


def model_type(path: str) -> int:
    """1 for unigram models, 2 for BPE models, as the file says."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model.trainer_spec.model_type


class PieceModel:
    """The pieces of a model file, and encoding and decoding by them."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES, follow_most: int = 400_000) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.memo, self.follow_most = common.Memo(self._packed, memo_bytes), follow_most
        self.byte_ids = [0] * 256
        self.single: set[str] = set()
        self.bytes_of: list[bytes] = [b""] * n
        self.automaton = ahocorasick.Automaton()
        self.lengths = [0] * n
        lowest, crossing, joined = 0.0, False, set()
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                score = model.get_score(i)
                lowest = min(lowest, score)
                self.automaton.add_word(piece, (len(piece), i, score))
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                self.lengths[i] = len(piece)
                joined.update(b for a, b in zip(piece, piece[1:], strict=False) if a.isalpha())
                crossing |= SPACE in piece.lstrip(SPACE)
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.merging = model_type(path) == BPE
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.merges: dict[str, list[tuple[float, str, str]] | None] = {}
        self.follow_memo: dict[int, bool] = {}
        self.unknown = lowest - UNKNOWN_PENALTY
        # Marks that no piece holds right after a letter: words are cut there as well, so that the memo meets fewer words.
        marks = set(".,!?;:*#$%&|\"()\n") - joined
        c = "".join(map(re.escape, sorted(marks))) or "\ue000"
        go_on = f"(?:[^{SPACE}{c}]|(?<![^\\W\\d_])[{c}])"
        self.words = None if crossing else re.compile(f"{SPACE}*{go_on}+|{SPACE}+|[{c}]{go_on}*")

    def _score(self, text: str) -> float | None:
        found = self.automaton.get(text, None)
        return None if found is None else found[2]

    def _merges(self, text: str) -> list[tuple[float, str, str]] | None:
        """Score, and last and first symbol afterwards, of each merge that makes a piece of its characters; None if none does."""
        if text not in self.merges:
            symbols, out = list(text), []
            while len(symbols) > 1:
                scored = [(s, -k) for k in range(len(symbols) - 1) if (s := self._score(symbols[k] + symbols[k + 1])) is not None]
                if not scored:
                    break
                score, k = max(scored)
                symbols[-k : 2 - k] = [symbols[-k] + symbols[1 - k]]
                out.append((score, symbols[-1], symbols[0]))
            self.merges[text] = out if len(symbols) == 1 else None
        return self.merges[text]

    def follows(self, left: str, right: str) -> bool:
        """True if merging the two pieces' characters gives these two pieces: no merge crosses their border."""
        ours, theirs = self._merges(left), self._merges(right)
        if ours is None or theirs is None:
            return False
        x, y, i, j = left[-1], right[0], 0, 0
        while True:
            here = ours[i][0] if i < len(ours) else None
            there = theirs[j][0] if j < len(theirs) else None
            across = self._score(x + y)
            # The highest score merges first, the leftmost of equal ones.
            if across is not None and (here is None or across > here) and (there is None or across >= there):
                return False
            if here is None and there is None:
                return True
            if there is None or here is not None and here >= there:
                x, i = ours[i][1], i + 1
            else:
                y, j = theirs[j][2], j + 1

    def _segment_merging(self, text: str) -> list[int]:
        """As ``segment``, for BPE models: the last piece of each prefix is the one that may follow."""
        last, lengths, memo = [FIRST] + [0] * len(text), self.lengths, self.follow_memo
        if len(memo) > self.follow_most:
            memo.clear()
        done = 0
        for at, (length, piece, _) in self.automaton.iter(text):
            if at < done:
                continue
            before = last[at + 1 - length]
            if (good := memo.get(key := before << 20 | piece)) is None:
                own = self.texts[piece]
                good = memo[key] = self._merges(own) is not None if before == FIRST else self.follows(self.texts[before], own)
            if good:
                done = at + 1
                last[done] = piece
        out, n = [], len(text)
        while n:
            out.append(last[n])
            n -= lengths[last[n]]
        out.reverse()
        return out

    def _segment_merging_unknown(self, text: str) -> list[int]:
        """The same with characters that are no piece of their own; each stands as itself until it becomes bytes."""
        last: list[str] = [""] * (len(text) + 1)
        ends: list[list[str]] = [[] for _ in last]
        for at, (length, _, _) in self.automaton.iter(text):
            ends[at + 1].append(text[at + 1 - length : at + 1])
        for end in range(1, len(last)):
            if text[end - 1] not in self.single:
                ends[end].append(text[end - 1])
            for own in ends[end]:
                before = last[end - len(own)]
                if self.follows(before, own) if before else self._merges(own) is not None:
                    last[end] = own
                    break
        out, n = [], len(text)
        while n:
            found = self.automaton.get(last[n], None)
            out += [found[1]] if found else [self.byte_ids[b] for b in reversed(last[n].encode())]
            n -= len(last[n])
        out.reverse()
        return out

    def segment(self, text: str) -> list[int]:
        """The ids of a text that is already written with U+2581."""
        n = len(text)
        if self.merging:
            return self._segment_merging(text) if self.single.issuperset(text) else self._segment_merging_unknown(text)
        if not self.single.issuperset(text):
            return self._segment_unknown(text)
        best, back, lengths = [0.0] + [float("-inf")] * n, [0] * (n + 1), self.lengths
        for last, (length, piece, score) in self.automaton.iter(text):
            end = last + 1
            if (total := best[end - length] + score) > best[end]:
                best[end], back[end] = total, piece
        out = []
        while n:
            out.append(back[n])
            n -= lengths[back[n]]
        out.reverse()
        return out

    def _segment_unknown(self, text: str) -> list[int]:
        """The same with characters that are no piece of their own."""
        n = len(text)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if text[done - 1] not in self.single:
                    score = best[done - 1] + self.unknown
                    if best[done] is None or score > best[done]:
                        best[done], back[done] = score, (1, -1)

        for last, (length, piece, score) in self.automaton.iter(text):
            end = last + 1
            if done < last:
                close(last)
            total = best[end - length] + score
            if best[end] is None or total > best[end]:
                best[end], back[end] = total, (length, piece)
        close(n)
        out: list[int] = []
        at = n
        while at:
            length, piece = back[at]
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(text[at - 1].encode())]
            at -= length
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        if SPACE in text:
            # Its own U+2581 must not read as white space.
            own = np.array([self.byte_ids[b] for b in SPACE.encode()], np.int32)
            head, *rest = text.split(SPACE)
            parts = [self.encode(head) if head else np.array(self.segment(SPACE), np.int32)]
            for part in rest:
                parts += [own, self._ids(part.replace(" ", SPACE))]
            return np.concatenate(parts)
        return self._ids(SPACE + text.replace(" ", SPACE))

    def _ids(self, text: str) -> np.ndarray:
        if self.words is None:
            return np.array(self.segment(text), np.int32)
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.words.findall(text))), "<i4")

    def _packed(self, text: str) -> bytes:
        return struct.pack(f"<{len(ids := self.segment(text))}i", *ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        table = self.bytes_of
        return b"".join(map(table.__getitem__, ids))[1:].decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, round_trip)``; ``round_trip``: the ids decode to the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        # Workers outlive tasks; what the last task has met does not stay in their memory.
        model.memo.clear()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [None if t is None else model.encode(t) for t in texts]
                same = [None if t is None else model.decode(i.tolist()) == t for t, i in zip(texts, ids, strict=True)]
                counts = pa.array([None if i is None else len(i) for i in ids], pa.int64())
                offsets = np.concatenate(([0], np.cumsum([0 if i is None else len(i) for i in ids]))).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *[i for i in ids if i is not None]]).astype(np.int32)
                gaps = np.array([i is None for i in ids] + [False])
                lists = pa.ListArray.from_arrays(pa.array(offsets, mask=gaps) if gaps.any() else pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), counts, lists, pa.array(same, pa.bool_())], schema=schema)
        model.memo.clear()

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``text``, decoded from ``ids``; null ids give null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = piece_model(path)
        for ids in batches:
            yield pd.Series([None if i is None else model.decode(list(i)) for i in ids], dtype=object)

    return common.without(rows, "text").withColumn("text", run("ids"))


def op8_sentencepieces(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    return encode_texts(common.read_table(spark, sf_dir, "documents"), path or default_model())
