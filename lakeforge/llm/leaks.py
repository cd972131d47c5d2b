"""Evaluation items leaking into a corpus (problem 9).

Method: pigeonhole edit matching.  Each item's text, reduced to its letters and digits, is cut into pieces of equal
length.  A window of ``budget + 1`` consecutive pieces that occurs in a document with at most ``budget`` edits must
contain one piece unchanged, so exact hits of pieces are a complete candidate search.  (A case is a third of an item, so
windows of the item are searched rather than the whole item; an item of fewer pieces is one window with one edit less
than it has pieces.)  Every candidate window is verified with Myers' bit-parallel edit distance, here run over thousands
of candidates at once, one 64-bit word each.  Around the verified windows an exact check adds the shorter stretches left
between changed words; windows and stretches together are the part of the item that the document holds.

Exact hits come from rolling hashes of the document's letters, looked up in the sorted hashes of the pieces; equal hashes
of different pieces only cost a verification.  No candidate is capped, and whole texts are read.

Text that stands in ``boilerplate_items`` different items or more is boilerplate: it neither finds nor counts.  An item of
little else is matched as a whole item instead.

Defined results: null, empty and symbol-only texts hold no item; null and empty items are never found; items shorter than
two pieces are found where their words stand in a row, whole; equal documents get equal rows; items of equal letters are
found together; every (doc_id, item_id) comes once.
Items are a held-out set that does not grow with the corpus: ``max_item_chars`` is checked before they are sent to the
workers, and larger sets are searched in as many passes as needed.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.spread import slices, spread
from lakeforge.llm.text import without_tags

_DROP = re.compile(r"[\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def plain(text: str | None) -> str:
    """One case, one width, without markup."""
    return unicodedata.normalize("NFKC", without_tags(html.unescape(text))).casefold() if text else ""


def letters(text: str | None) -> str:
    """Letters and digits only, one case, one width; markup, punctuation, spaces and line breaks are gone."""
    return _DROP.sub("", plain(text))


def is_cjk(text: str) -> bool:
    return sum("㐀" <= c <= "鿿" for c in text) * 3 > len(text)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def grams(of: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all stretches of ``n`` codes."""
    if len(of) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(of) - n + 1, np.uint64)
    for j in range(n):
        h *= _BASE
        h += of[j : len(of) - n + 1 + j]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


class ItemIndex:
    """Pieces and windows of a set of items; every array is as long as the items' letters at most."""

    def __init__(self, items: Iterable[tuple[int, str]], budget: int = 2, piece_latin: int = 12, piece_cjk: int = 6, boilerplate_items: int = 5):
        if (budget + 2) * max(piece_latin, piece_cjk) - 1 > 64:
            raise ValueError("a window must fit one 64-bit word: take a smaller budget or smaller pieces")
        ids: dict[str, list[int]] = defaultdict(list)
        short: dict[str, tuple[list[int], str]] = {}
        self.sizes = sorted({piece_latin, piece_cjk})
        for i, text in items:
            t = letters(text)
            g = piece_cjk if is_cjk(t) else piece_latin
            if len(t) >= 2 * g:
                ids[t].append(i)
            elif t:
                short.setdefault(t, ([], plain(text)))[0].append(i)
        self.texts, self.ids = list(ids), list(ids.values())
        self.size = [piece_cjk if is_cjk(t) else piece_latin for t in self.texts]
        self._short(short)
        self.start = np.concatenate(([0], np.cumsum([len(t) for t in self.texts]))).astype(np.int64)
        self.code = codes("".join(self.texts)) if self.texts else np.zeros(0, np.uint32)
        self.own = self._own(boilerplate_items)
        self.own_letters = [int(self.own[a:b].sum()) for a, b in zip(self.start, self.start[1:])]
        self._windows(budget)

    def _short(self, short: dict[str, tuple[list[int], str]]) -> None:
        """Items of less than two pieces: exact search of the letters, then their words in a row in the text."""
        self.short = ahocorasick.Automaton()
        for t, (ids, text) in short.items():
            # Chinese characters may stand apart or together, words may not be joined
            words = re.findall(r"[㐀-鿿]|[^\W_㐀-鿿]+", text)
            exact = "(?<!\\w)" * (not is_cjk(words[0]))
            for w, after in zip(words, [*words[1:], ""]):
                exact += re.escape(w) + ("" if not after else "[\\W_]*" if is_cjk(w) or is_cjk(after) else "[\\W_]+")
            self.short.add_word(t, (t, ids, re.compile(exact + "(?!\\w)" * (not is_cjk(words[-1])))))
        if short:
            self.short.make_automaton()
        self.has_short = bool(short)

    def _own(self, least: int) -> np.ndarray:
        """Which letters are no boilerplate.  Hashes of stretches of two pieces are counted, once an item."""
        own = np.ones(len(self.code), bool)
        for g in self.sizes:
            held = [n for n, x in enumerate(self.size) if x == g]
            hashes = [grams(self.code[self.start[n] : self.start[n + 1]], 2 * g) for n in held]
            if not hashes:
                continue
            each, times = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True)
            shared = each[times >= least]
            if not len(shared):
                continue
            for n, h in zip(held, hashes):
                at = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h)
                edge = np.zeros(len(self.texts[n]) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + 2 * g, -1)
                mark = np.cumsum(edge[:-1]) > 0
                # stretches of less than three pieces may be chance, such as a common phrase
                turn = np.flatnonzero(np.diff(np.concatenate(([0], mark.view(np.int8), [0]))))
                for a, b in zip(turn[::2], turn[1::2]):
                    if b - a < 3 * g:
                        mark[a:b] = False
                if (~mark).sum() >= 2 * g:
                    own[self.start[n] : self.start[n + 1]] = ~mark
        return own

    def _windows(self, budget: int) -> None:
        w_item, w_start, w_len, w_budget, p_hash, p_window, p_offset = ([] for _ in range(7))
        made = 0
        for n, g in enumerate(self.size):
            a, b = int(self.start[n]), int(self.start[n + 1])
            q = (b - a) // g
            k = min(budget + 1, q)
            s = np.arange(q - k + 1)
            length = np.full(len(s), k * g)
            length[-1] += (b - a) - q * g  # what is left belongs to the last window
            known = np.concatenate(([0], np.cumsum(self.own[a:b])))
            s, length = (x[(known[s * g + length] - known[s * g]) * 2 >= length] for x in (s, length))
            piece = grams(self.code[a : a + q * g], g)[::g]
            w_item.append(np.full(len(s), n)), w_start.append(a + s * g), w_len.append(length), w_budget.append(np.full(len(s), k - 1))
            for x in range(k):
                p_hash.append(piece[s + x]), p_window.append(made + np.arange(len(s))), p_offset.append(np.full(len(s), x * g))
            made += len(s)
        join = lambda xs, kind: np.concatenate(xs).astype(kind) if xs else np.zeros(0, kind)
        self.w_item, self.w_start, self.w_len, self.w_budget = join(w_item, np.int32), join(w_start, np.int64), join(w_len, np.int64), join(w_budget, np.int64)
        h = join(p_hash, np.uint64)
        order = np.argsort(h, kind="stable")
        self.flat_window, self.flat_offset = join(p_window, np.int64)[order], join(p_offset, np.int64)[order]
        self.hashes, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h)).astype(np.int64)
        self.bits = max(16, int(len(self.hashes) * 16).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self.hashes >> np.uint64(64 - self.bits)] = True

    def hits(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose piece occurs, and where the window would start."""
        wins, ats = [], []
        for g in self.sizes if len(self.hashes) else ():
            h = grams(doc, g)
            at = np.flatnonzero(self.maybe[h >> np.uint64(64 - self.bits)])
            h = h[at]
            x = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            same = self.hashes[x] == h
            x, at = x[same], at[same]
            n = self.first[x + 1] - self.first[x]
            flat = np.repeat(self.first[x] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(x) else np.zeros(0, np.int64)
            wins.append(self.flat_window[flat]), ats.append(np.repeat(at, n) - self.flat_offset[flat])
        if not wins:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        win, at = np.concatenate(wins), np.concatenate(ats)
        order = np.lexsort((at, win))
        win, at = win[order], at[order]
        new = np.ones(len(win), bool)
        new[1:] = (win[1:] != win[:-1]) | (at[1:] != at[:-1])
        return win[new], at[new]

    def verify(self, win: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which windows occur within their budget in doc[at - budget : at + length + budget].

        Myers' algorithm, one candidate a word.  The bits where a pattern has the text's letter are compared anew for
        each letter, so no table of patterns and letters is kept."""
        m, k = self.w_len[win], self.w_budget[win]
        pattern = np.zeros((len(win), 64), np.uint32)
        inside = np.arange(64) < m[:, None]
        pattern[inside] = self.code[(self.w_start[win][:, None] + np.arange(64))[inside]]
        lo, hi = np.maximum(at - k, 0), np.minimum(at + m + k, len(doc))
        one = np.uint64(1)
        top = one << (m - 1).astype(np.uint64)
        pv = np.full(len(win), ~np.uint64(0))
        mv = np.zeros(len(win), np.uint64)
        score, best = m.copy(), m.copy()
        for j in range(int((hi - lo).max(initial=0))):
            pos = lo + j
            live = pos < hi
            c = np.where(live, doc[np.minimum(pos, len(doc) - 1)], 0)
            eq = np.packbits((pattern == c[:, None]) & (c != 0)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            score = score + ((ph & top) != 0) - ((mh & top) != 0)
            ph = ph << one  # the match may start anywhere: no carry in
            mh = mh << one
            pv = mh | ~(xv | ph)
            mv = ph & xv
            best = np.where(live, np.minimum(best, score), best)
        return best <= k

    def shares(self, texts: list[str | None], block: int = 20_000) -> Iterator[tuple[int, int, float]]:
        """(index of the text, item, share of the item's own letters found)."""
        flat = [plain(t) for t in texts]
        kept = [_DROP.sub("", t) for t in flat]
        if self.has_short:
            yield from self._short_found(flat, kept)
        text = "\0".join(kept)  # no piece holds the separator
        doc = codes(text)
        win, at = self.hits(doc)
        if not len(win):
            return
        ok = np.concatenate([self.verify(win[s : s + block], at[s : s + block], doc) for s in range(0, len(win), block)])
        win, at = win[ok], at[ok]
        ends = np.cumsum([len(t) + 1 for t in kept])
        # a window may start or end beyond its document by its edits; its middle lies inside
        own = np.searchsorted(ends, np.maximum(at + self.w_len[win] // 2, 0), side="right")
        held: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for i, n, w, a in zip(own.tolist(), self.w_item[win].tolist(), win.tolist(), at.tolist()):
            held[i, n].append((a, w))
        for (i, n), found in held.items():
            if i >= len(kept):
                continue
            share = self._share(n, found, text, int(ends[i]) - 1 - len(kept[i]), int(ends[i]) - 1)
            for item in self.ids[n]:
                yield i, item, share

    def _short_found(self, flat: list[str], kept: list[str]) -> Iterator[tuple[int, int, float]]:
        for i, t in enumerate(kept):
            for word, ids, exact in {v[0]: v for _, v in self.short.iter(t)}.values():
                if exact.search(flat[i]):
                    for item in ids:
                        yield i, item, 1.0

    def _share(self, n: int, found: list[tuple[int, int]], text: str, lo: int, hi: int) -> float:
        a, b = int(self.start[n]), int(self.start[n + 1])
        mark = np.zeros(b - a, bool)
        spans: list[list[int]] = []
        for at, w in sorted(found):
            s = int(self.w_start[w]) - a
            mark[s : s + int(self.w_len[w])] = True
            x, y = max(lo, at - (b - a)), min(hi, at + (b - a))
            if spans and x <= spans[-1][1]:
                spans[-1][1] = max(y, spans[-1][1])
            else:
                spans.append([x, y])
        # exact check after a verified window: what else of the item stands unchanged around the windows
        t, g = self.texts[n], self.size[n] * 2 // 3
        near = {text[p : p + g] for x, y in spans for p in range(x, y - g + 1)}
        for p in range(len(t) - g + 1):
            if t[p : p + g] in near:
                mark[p : p + g] = True
        own = self.own[a:b]
        return float((mark & own).sum() / self.own_letters[n])


_BUILT: dict[str, ItemIndex] = {}


def built_index(name: str, build: Callable[[], ItemIndex]) -> ItemIndex:
    """The index of one search, once in each worker process; a function of the module, so that tasks share its store."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = build()
    return _BUILT[name]


def leak_shares(documents: DataFrame, items: DataFrame, max_item_chars: int = 4_000_000, **how) -> DataFrame:
    """doc_id, item_id, share of every document that holds some window of an item.  One pass over the corpus (for each
    ``max_item_chars`` of items); ``spread`` moves a small table first."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    passes = max(1, -(-total // max_item_chars))
    docs = spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null and length(text) > 0"))
    out = []
    for p in range(passes):
        part = [(r.item_id, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).distinct().orderBy("item_id", "text").toLocalIterator()]
        out.append(_search(docs, part, how))
    return reduce(DataFrame.unionByName, out)


def _search(docs: DataFrame, part: list[tuple[int, str]], how: dict) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(part)
    name = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = built_index(name, lambda: ItemIndex(sent.value, **how))
        for b in slices(batches, 1):
            ids = b.column(0).to_pylist()
            found = list(index.shares(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _, _ in found], pa.int64()), pa.array([n for _, n, _ in found], pa.int64()), pa.array([x for _, _, x in found], pa.float64())],
                ["doc_id", "item_id", "share"],
            )

    return docs.mapInArrow(search, "doc_id bigint, item_id bigint, share double")


def leaked_items(documents: DataFrame, items: DataFrame, least_share: float = 1 / 3, **how) -> DataFrame:
    """(doc_id, item_id) where the document holds a third of the item."""
    return leak_shares(documents, items, **how).where(F.col("share") >= least_share).select("doc_id", "item_id").distinct()
