"""Keyword-stuffed pages, link lists and tag walls (problem 10).

Method: a suffix automaton is built over the tokens of each page.  Walking the page through it gives,
for every position, the longest substring ending there that occurs at least ``min_repeats`` times, so the
letters covered by repeated maximal substrings are known exactly, in time linear in the page.  A repeat
counts as stuffing only where clause structure is missing.  Links always count, since an address is no sentence.

Clause structure is read off the page alone, without words of any language.  A unit (up to a terminator or line end)
is a clause if it ends with a terminator, has the length of a sentence, is not set with list marks, and is not made of
the few tokens that the whole page repeats in half of its units (function words take little room there, keywords most; a
sentence said again and again has more of them, and stays one).

Fenced blocks that are closed and hold code (punctuation among the words) are no stuffing, but count as text of the page.

Defined results: null, empty and letter-free pages have share 0 and are never reported.  Repeated documents
are judged one by one, so equal texts get equal verdicts.  Whole texts are read, however long: an automaton has at
most two states a token; beyond ``AUTOMATON_TOKENS`` tokens the same coverage comes from a suffix array, which needs
less memory.  Extra input columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.spread import slices, spread
from lakeforge.llm.text import TAG

#: Pages of more tokens are covered by a suffix array instead of an automaton; both give the same coverage.
AUTOMATON_TOKENS = 1_000_000

_TOKEN = re.compile(
    r"(?P<url>(?:https?:)?//[^\s)\"'<>\]]+|www\.[^\s)\"'<>\]]+)|(?P<tag>" + TAG + r")|(?P<code>\d{6}\.[A-Z]{2})|(?P<num>\d[\d.,:/-]*)"
    r"|(?P<cjk>[㐀-鿿])|(?P<word>[^\W\d_]+(?:\.(?=[^\W_]))?)|(?P<nl>\n)|(?P<other>[^\w\s]|_)"
)
_SPLIT = re.compile(re.sub(r"\(\?P<\w+>", "(?:", _TOKEN.pattern))
_KINDS = {k: i for i, k in enumerate(("url", "tag", "code", "num", "cjk", "word", "nl", "other"))}
_URL, _TAG, _CODE, _NUM, _CJK, _WORD, _NL, _OTHER = range(8)
_STOPS = frozenset(".!?。！？…")
_MARKS = frozenset("#|»›>·•")
_FENCE = re.compile(r"^```.*?^```[^\S\n]*$", re.S | re.M)
_CODE_MARKS = re.compile(r"[(){}\[\]=;<>*+_%$&,.'\"]")
_WORDS = re.compile(r"[^\W\d_]+")
_HREF = re.compile(r"""<a\s[^<>]*href\s*=\s*["']?([^"'<>\s]*)""", re.I)
_BLOCK = re.compile(r"</?(?:p|div|li|ul|ol|br|h\d|tr|table|section|article|nav)\b", re.I)


def suffix_automaton(tokens: list) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """Lengths, suffix links, occurrence counts, the state of each prefix, and the states by length."""
    room = 2 * len(tokens) + 1
    length, link, count = [0] * room, [0] * room, [0] * room
    step: list[dict] = [{}]
    link[0] = -1
    at: list[int] = []
    last, size = 0, 1
    for t in tokens:
        cur = size
        size += 1
        step.append({})
        length[cur] = length[last] + 1
        count[cur] = 1
        p = last
        known = step[p]
        while t not in known:
            known[t] = cur
            p = link[p]
            if p < 0:
                break
            known = step[p]
        else:
            q = known[t]
            n = length[p] + 1
            if n == length[q]:
                link[cur] = q
            else:
                clone = size
                size += 1
                step.append(step[q].copy())
                length[clone] = n
                link[clone] = link[q]
                while p >= 0 and step[p].get(t) == q:
                    step[p][t] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
        at.append(cur)
    order = sorted(range(1, size), key=length.__getitem__)
    for s in reversed(order):
        count[link[s]] += count[s]
    return length, link, count, at, order


def repeated_positions(tokens: list, min_repeats: int = 3) -> bytearray:
    """1 for each token inside some substring that occurs ``min_repeats`` times or more."""
    covered = bytearray(len(tokens))
    if not tokens:
        return covered
    if len(tokens) > AUTOMATON_TOKENS:
        return covered_by_suffixes(tokens, min_repeats)
    length, link, count, at, order = suffix_automaton(tokens)
    # longest suffix of each state's strings that is repeated often enough; links point to shorter strings
    best = [0] * len(length)
    for s in order:
        best[s] = length[s] if count[s] >= min_repeats else best[link[s]]
    reach = len(tokens)
    for i in range(len(tokens) - 1, -1, -1):
        start = i - best[at[i]] + 1
        if start <= i and start < reach:
            end = min(i + 1, reach)
            covered[start:end] = b"\1" * (end - start)
            reach = start
    return covered


def covered_by_suffixes(tokens: list, min_repeats: int) -> bytearray:
    """``repeated_positions`` from a suffix array (prefix doubling) and the common prefixes of its neighbours."""
    n = len(tokens)
    names = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
    text = np.fromiter((names[t] for t in tokens), np.int64, n)
    rank, step = text + 1, 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        step *= 2
        if rank[order[-1]] == n or step >= n:
            break
    place, suffix, plain = (rank - 1).tolist(), order.tolist(), text.tolist()
    common, h = [0] * n, 0
    for i in range(n):
        r = place[i]
        if r:
            j = suffix[r - 1]
            while i + h < n and j + h < n and plain[i + h] == plain[j + h]:
                h += 1
            common[r] = h
            h -= h > 0
        else:
            h = 0
    lcp = np.array(common, np.int64)
    best = np.zeros(n, np.int64)
    if min_repeats <= 1:
        return bytearray(b"\1" * n)
    # the least of min_repeats - 1 neighbouring prefixes is shared by min_repeats suffixes in a row
    shared = lcp[1:].copy()
    for k in range(1, min_repeats - 1):
        shared = np.minimum(shared[:-1], lcp[1 + k :][: len(shared) - 1])
    for k in range(min_repeats):  # suffixes first .. first + min_repeats - 1 hold it
        best[k : k + len(shared)] = np.maximum(best[k : k + len(shared)], shared)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, order, best > 0)
    np.add.at(edge, np.minimum(order + best, n), -(best > 0).astype(np.int64))
    return bytearray((np.cumsum(edge[:n]) > 0).astype(np.uint8).tobytes())


#: What a token is, by its text: kind, key in the automaton, size and lower-cased word.  Emptied when it grows too large.
_KNOWN: dict[str, tuple[int, str, int, str]] = {}
_MOST_KNOWN = 500_000


def _token(s: str) -> tuple[int, str, int, str]:
    k = _KINDS[_TOKEN.match(s).lastgroup]
    n, key, word = len(s), s, s
    if k == _TAG:
        key = word = s[:3].lower()
        if word in ("<a ", "<a>"):
            href = _HREF.match(s)
            key, word, n = "<a>", "<a>", len(href.group(1)) if href else 0
        elif word == "</a":
            key, n = "</a>", 0
        else:
            n = 0
            if _BLOCK.match(s):
                k = _NL
    elif k == _URL:
        key = "<url>"
    elif k in (_CODE, _NUM):
        key = "<n>"
    elif k == _WORD:
        key = word = s.lower()
    elif k == _NL:
        n = 0
    if len(_KNOWN) >= _MOST_KNOWN:
        _KNOWN.clear()
    if len(s) <= 100:
        _KNOWN[s] = (k, key, n, word)
    return k, key, n, word


def tokens_of(text: str) -> list[tuple[int, str, int, str]]:
    known = _KNOWN.get
    return [known(s) or _token(s) for s in _SPLIT.findall(text)]


def _without_code(text: str) -> tuple[str, int]:
    """The text without closed fences that hold code, and the visible characters of these."""
    if "```" not in text:
        return text, 0
    hidden = 0

    def drop(m: re.Match) -> str:
        nonlocal hidden
        body = m.group().strip("`")
        if len(_CODE_MARKS.findall(body)) * 4 < len(_WORDS.findall(body)):
            return body
        hidden += sum(len(x) for x in body.split())
        return "\n"

    return _FENCE.sub(drop, text), hidden


def page_profile(text: str | None, min_repeats: int = 3, max_clause_words: int = 60, spread_over: float = 0.5, least_units: int = 8, most_keywords: int = 8) -> tuple[int, int]:
    """(visible characters of the page, those of stuffing, links and tags)."""
    if not text:
        return 0, 0
    text, total = _without_code(html.unescape(text))
    toks = tokens_of(text)
    if not toks:
        return total, 0
    kind, seq, size, word = zip(*toks)
    linked: list[int] | bytes = bytes(len(toks))
    if "<a>" in seq:
        linked, inside = [], 0
        for k, w in zip(kind, word):
            if k == _TAG and w in ("<a>", "</a"):
                inside = int(w == "<a>")
            linked.append(inside)
    total += sum(size)
    units: list[tuple[int, int, bool]] = []
    start = 0
    for i in range(len(seq) + 1):
        stop = i < len(seq) and kind[i] == _OTHER and word[i] in _STOPS
        if i == len(seq) or stop or kind[i] == _NL:
            if i > start:
                units.append((start, i, stop))
            start = i + 1
    everywhere: set[str] = set()
    if len(units) >= least_units:
        held = Counter()
        for a, b, _ in units:
            held.update(set(seq[a:b]))
        everywhere = {t for t, n in held.items() if n >= spread_over * len(units)}
        if len(everywhere) > most_keywords:
            everywhere = set()
    bad, listed = 0, []
    for a, b, stop in units:
        links, prose = _clause(range(a, b), kind, seq, word, size, linked, everywhere, stop, max_clause_words)
        if prose:
            bad += links
        else:
            listed.append((a, b))
    if listed:  # what repeats do matters only where clauses are missing
        covered = repeated_positions(seq, min_repeats)
        bad += sum(_stuffed(range(a, b), kind, size, covered, linked) for a, b in listed)
    return total, bad


def _clause(span: range, kind, seq, word, size, linked, everywhere: set[str], stopped: bool, max_clause_words: int) -> tuple[int, bool]:
    """Characters of the unit's links, and whether it is a clause."""
    words = cjk = links = marks = letters = common = 0
    for j in span:
        k = kind[j]
        if k == _URL or k == _TAG or linked[j]:
            links += size[j]
        elif k == _WORD or k == _CJK:
            letters += size[j]
            if seq[j] in everywhere:
                common += size[j]
        if k == _WORD:
            words += 1
        elif k == _CJK:
            cjk += 1
        elif k == _OTHER and word[j] in _MARKS:
            marks += 1
    long_enough = 4 <= words <= max_clause_words if words >= cjk else 6 <= cjk <= 2 * max_clause_words
    return links, stopped and long_enough and marks * 4 <= words + cjk / 2 and common * 4 < 3 * letters


def _stuffed(span: range, kind, size, covered, linked) -> int:
    """Characters of a unit without clause structure that are repeats, links or tags."""
    links = letters = repeated = chars = 0
    for j in span:
        k, n = kind[j], size[j]
        chars += n
        if k == _URL or k == _TAG or linked[j]:
            links += n
        elif k == _WORD or k == _CJK:
            letters += n
            if covered[j]:
                repeated += n
    if not letters + links:
        return 0
    if repeated * 4 >= letters > 0 or links * 2 >= chars:
        return chars
    return links + repeated


def stuffing_shares(documents: DataFrame, min_repeats: int = 3) -> DataFrame:
    """doc_id, n_chars, stuffed_chars and stuffed_share of every document in one pass; ``spread`` moves a small table first."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = [page_profile(t, min_repeats) for t in b.column(1).to_pylist()]
            total = pa.array([t for t, _ in found], pa.int64())
            bad = pa.array([x for _, x in found], pa.int64())
            share = pa.array([x / t if t else 0.0 for t, x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), total, bad, share], ["doc_id", "n_chars", "stuffed_chars", "stuffed_share"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(docs).mapInArrow(profile, "doc_id bigint, n_chars bigint, stuffed_chars bigint, stuffed_share double")


def stuffed_pages(documents: DataFrame, threshold: float = 0.5, min_repeats: int = 3) -> DataFrame:
    """doc_id of the pages of which more than ``threshold`` is stuffing; every id once."""
    return stuffing_shares(documents, min_repeats).where(F.col("stuffed_share") > threshold).select("doc_id").distinct()
