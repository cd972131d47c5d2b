"""Encoding a corpus with a public byte-level BPE vocabulary (problem 8).

Method: a bounded-lookahead streaming transducer.  A text is read once, pretoken by pretoken.  Two facts of
the merge list are computed when the vocabulary is loaded:

* the byte pairs that stand next to each other inside some token.  Between two bytes that never do, no merge
  can cross, so one byte of lookahead settles everything before: the pretoken is cut there.
* the longest token.  Inside what remains, the transducer keeps, for every byte position, the last token of
  the encoding of the bytes so far (it is unique: it is the only one compatible with the token before it).
  Any later token starts within the last ``lookahead`` positions, so tokens on which the chains from all those
  positions agree are stable and are emitted; the rest is the whole memory of the machine.

Decoding is a byte-to-text state machine fed token by token, which holds back at most three bytes.

Defined results: null and empty texts give an empty list; strings that look like special tokens are ordinary
text; repeated documents get equal lists; texts of any length are encoded whole.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.spread import slices, spread

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pretokens of this family of vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class MergeList:
    """Ranks of the tokens and what follows from them."""

    def __init__(self, vocabulary: str | bytes):
        data = Path(vocabulary).read_bytes() if isinstance(vocabulary, str) else vocabulary
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.lookahead = max(map(len, self.ranks)) - 1
        self.inner = {a << 8 | b for t in self.ranks for a, b in zip(t, t[1:])}
        self._fits: dict[tuple[int, int], bool] = {}
        # the longest token by its last three bytes: how far back a token that ends here can begin
        ends: dict[bytes, int] = {}
        for t in self.ranks:
            if len(t) > 2:
                ends[t[-3:]] = max(ends.get(t[-3:], 0), len(t))
        self.longest_by_end = ends

    def merge(self, word: bytes) -> list[int]:
        """The merges of a short word by rank; only used to judge pairs of tokens."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` in an encoding."""
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 1_000_000:
                self._fits.clear()
            known = self._fits[key] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known


class Transducer:
    """Encodes one pretoken fed in pieces; memory is bounded by the lookahead, not by the pretoken."""

    def __init__(self, merges: MergeList, window: int = 1024):
        self.merges = merges
        self.window = window + 2 * merges.lookahead
        self.text = bytearray()
        self.last: list[int] = []  # last[i]: the last token of the encoding of text[: i + 1]
        self.before = -1  # the token emitted last

    def feed(self, piece: bytes) -> Iterator[int]:
        for b in piece:
            self.text.append(b)
            self._advance()
            if len(self.text) >= self.window:
                yield from self._stable()

    def _advance(self) -> None:
        end = len(self.text)
        ranks, last, fits = self.merges.ranks, self.last, self.merges.fits
        most = min(end, self.merges.longest_by_end.get(bytes(self.text[-3:]), 2))
        tail = bytes(self.text[-most:])
        for cut in range(most):  # the longest first
            t = ranks.get(tail[cut:])
            if t is None:
                continue
            at = end - most + cut
            left = last[at - 1] if at else self.before
            if left == -1 or fits(left, t):
                last.append(t)
                return
        raise ValueError("the vocabulary lacks a single byte")

    def _chain(self, end: int, stop: int = 0) -> list[int]:
        out = []
        while end > stop:
            t = self.last[end - 1]
            out.append(t)
            end -= len(self.merges.tokens[t])
        return out[::-1]

    def _stable(self) -> Iterator[int]:
        size = {*range(max(0, len(self.text) - self.merges.lookahead), len(self.text) + 1)}
        while len(size) > 1:
            far = max(size)
            size.discard(far)
            size.add(far - len(self.merges.tokens[self.last[far - 1]]))
        cut = size.pop()
        if cut:
            out = self._chain(cut)
            yield from out
            self.before = out[-1]
            del self.text[:cut], self.last[:cut]

    def finish(self) -> Iterator[int]:
        yield from self._chain(len(self.text))
        self.text.clear()
        self.last.clear()
        self.before = -1


class Encoder:
    def __init__(self, path: str = DEFAULT_VOCABULARY, cache: int = 300_000):
        self.merges = MergeList(path)
        self.pattern = regex.compile(PRETOKEN)
        self.cache_size = cache
        self.words: dict[str, list[int]] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}

    def _part(self, part: bytes) -> tuple[int, ...]:
        known = self.parts.get(part)
        if known is None:
            whole = self.merges.ranks.get(part)
            if whole is not None:  # the machine's last state would be this token, with nothing before it
                known = (whole,)
            else:
                m = Transducer(self.merges)
                known = (*m.feed(part), *m.finish())
            if len(part) <= 64:
                if len(self.parts) >= self.cache_size:
                    self.parts.clear()
                self.parts[part] = known
        return known

    def _word(self, word: str) -> list[int]:
        """A pretoken, cut where one byte of lookahead settles it."""
        if len(word) > 4096:
            return list(self._giant(word))
        data = word.encode("utf-8", "replace")
        inner, parts, out, start, prev = self.merges.inner, self.parts, [], 0, data[0]
        for i in range(1, len(data)):
            b = data[i]
            if prev << 8 | b not in inner:
                part = data[start:i]
                out += parts.get(part) or self._part(part)
                start = i
            prev = b
        part = data[start:]
        out += parts.get(part) or self._part(part)
        return out

    def _giant(self, word: str) -> Iterator[int]:
        inner = self.merges.inner
        held = bytearray()
        machine: Transducer | None = None
        prev = -1
        for s in range(0, len(word), 4096):
            for b in word[s : s + 4096].encode("utf-8", "replace"):
                if prev >= 0 and prev << 8 | b not in inner:
                    yield from self._settled(machine, held)
                    machine = None
                held.append(b)
                prev = b
                if len(held) >= 4096:  # a giant run: the machine emits as it goes
                    machine = machine or Transducer(self.merges)
                    yield from machine.feed(bytes(held))
                    held.clear()
        yield from self._settled(machine, held)

    def _settled(self, machine: Transducer | None, held: bytearray) -> Iterator[int]:
        if machine:
            yield from machine.feed(bytes(held))
            yield from machine.finish()
        else:
            yield from self._part(bytes(held))
        held.clear()

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        words, put = self.words, out.extend
        # short texts at once; long ones pretoken by pretoken, so that no list of them is held
        for w in self.pattern.findall(text) if len(text) <= 100_000 else (m.group() for m in self.pattern.finditer(text)):
            known = words.get(w)
            if known is None:
                known = self._word(w)
                if len(w) > 64:
                    put(known)
                    continue
                if len(words) >= self.cache_size:
                    words.clear()
                words[w] = known
            put(known)
        return out


class Decoder:
    """Byte-to-text state machine: tokens in, complete characters out, at most three bytes held back."""

    def __init__(self, merges: MergeList):
        self.tokens = merges.tokens
        self.need = 0
        self.held = bytearray()

    def feed(self, token: int) -> str:
        data = self.tokens[token]
        cut = len(data)
        for b in data:
            if self.need:
                self.need -= 1
            elif b >= 0xC0:
                self.need = 1 + (b >= 0xE0) + (b >= 0xF0)
        self.held += data
        if not self.need:
            out = self.held.decode("utf-8")
            self.held.clear()
            return out
        cut = len(self.held) - 1
        while self.held[cut] & 0xC0 == 0x80:
            cut -= 1
        out = self.held[:cut].decode("utf-8")
        del self.held[:cut]
        return out

    def decode(self, tokens: Iterable[int]) -> str:
        return "".join(map(self.feed, tokens))


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes) -> Encoder:
    """One for each worker process."""
    return Encoder(vocabulary)


def encode_corpus(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id and ids of every document; ``spread`` moves a small table first, memory is bounded by a slice of a batch.

    The vocabulary is a file of the driver and is sent to the workers (one file of a few megabytes at most)."""
    sent = documents.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(sent.value)
        for part in slices(batches, 1):
            lists = [e.encode(t) for t in part.column(1).to_pylist()]
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.fromiter((t for x in lists for t in x), np.int32, int(offsets[-1]))
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(docs).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_corpus(encoded: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id and text of lists of ids; null lists give null."""
    sent = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(sent.value).merges
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                b = batch.slice(s, 500)
                texts = [None if x is None else Decoder(merges).decode(x) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
