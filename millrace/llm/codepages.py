"""Problem 3: text decoded with the wrong code page.

Method: an unknown code-page swap is a substitution cipher whose units (one or several displayed characters) stand for
letters. A character bigram model is counted over all texts by expectation-maximization: lines that may be garbled are
decoded by the present model, and the model is counted again. A second EM learns, per source, how likely each swap is; a third
one, per source and one-byte cipher, which letter each shown character stands for. That one starts from code pages, or, for
lines that no page explains, from nothing but the frequency of letters, and runs over all sources before it runs over each, as
a source alone is thin. A line is read by the swap of its highest posterior with translate() and the mapping learnt; where one
unit has several characters (UTF-8 or GBK shown in another page), by the swap's unit table.

A value that keeps U+FFFD after that is found, and restored as far as possible.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..cluster import cut
from .arrowtext import batches, code_points
from .corpus import BODY, KEY, REWRITE, SOURCE, body_of, keyed

#: Share of all pairs from which a pair of characters counts as seen.
LEAST_PAIR = 4e-7
# Signs that stand beside letters above ASCII in clean text.
USUAL_SIGNS = "\u00a0«»‘’“”„…–—•·°º\u2009\u202f"
HASH_BITS = 21
TOP = 0x20000
LOST = "�"
#: Characters above ASCII that a line must have before a one-byte swap is tried.
LEAST_LETTERS = 4
# Pages in which UTF-8 bytes are found displayed.
UTF8_IN = ["cp1252", "mac_roman", "cp1250", "cp437", "cp850", "cp1251", "cp866", "koi8_r"]
# Fixed values: (true page, displayed page) of one-byte swaps.
ONE_BYTE = [
    ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp1251", "cp1252"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("koi8_r", "cp1252"), ("koi8_r", "cp866"),
    ("cp866", "cp1252"), ("iso8859_5", "cp1251"), ("iso8859_5", "cp1252"), ("cp1251", "mac_roman"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "cp437"), ("mac_roman", "cp1252"),
]


def _shown(page: str) -> list[str]:
    """The 256 characters a page shows; where it has none, the code point of the byte (as latin-1 does)."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _class(chars) -> str:
    return "[" + "".join(re.escape(c) for c in sorted(set(chars))) + "]"


class _Utf8In:
    """UTF-8 shown in a one-byte page: units of two to four characters."""

    def __init__(self, page: str):
        self.name = f"utf_8 as {page}"
        shown = _shown(page)
        self.byte = {c: b for b, c in enumerate(shown) if b >= 0x80}
        tail = shown[0x80:0xC0]
        if page == "cp1252":
            self.byte |= {chr(b): b for b in range(0x80, 0xA0)}
            tail = tail + [chr(b) for b in range(0x80, 0xA0)]
        t = _class(tail)
        self.unit = re.compile(f"{_class(shown[0xC2:0xE0])}{t}|{_class(shown[0xE0:0xF0])}{t}{{2}}|{_class(shown[0xF0:0xF5])}{t}{{3}}")
        self.known: dict[str, str] = {}

    def _letter(self, m) -> str:
        u = m.group()
        if u not in self.known:
            try:
                self.known[u] = bytes(self.byte[c] for c in u).decode("utf-8")
            except UnicodeDecodeError:
                self.known[u] = u
        return self.known[u]

    def __call__(self, s: str) -> str:
        return self.unit.sub(self._letter, s)


class _Twice:
    def __init__(self, once):
        self.name, self.once = f"{once.name}, twice", once

    def __call__(self, s: str) -> str:
        a = self.once(s)
        b = a if a == s else self.once(a)
        return s if b == a else b


class _RunSwap:
    """Runs of characters above ASCII, shown in one multi-byte page and true in another."""

    def __init__(self, true: str, shown: str, lost: float):
        self.name, self.true, self.shown, self.lost = f"{true} as {shown}", true, shown, lost
        self.run = re.compile(r"[^\x00-\x7f]+")
        # what the shown page never shows: such a line isn't looked at any further
        self.shows = re.compile("[\u3400-\u9fff]") if shown == "gbk" else re.compile("[\xa1-\xfe]{2}")
        self.byte = {c: bytes([b]) for b, c in enumerate(_shown("cp1252")) if b >= 0x80} | {chr(b): bytes([b]) for b in range(0x80, 0xA0)}
        self.known: dict[str, str] = {}

    def _bytes(self, c: str) -> bytes:
        if c == LOST:
            return b"\xff"
        if self.shown == "cp1252":
            return self.byte.get(c, b"\xff\xff")
        try:
            return c.encode(self.shown)
        except UnicodeEncodeError:
            return c.encode("utf-8") if self.shown == "gbk" and ord(c) < 0x100 else b"\xff"

    def _text(self, m) -> str:
        u = m.group()
        if u not in self.known:
            if len(self.known) > 20000:
                self.known.clear()
            try:
                raw = u.encode("gbk") if self.shown == "gbk" else b"".join(map(self._bytes, u))
            except UnicodeEncodeError:
                raw = b"".join(map(self._bytes, u))
            out = re.sub(LOST + "+", LOST, raw.decode(self.true, errors="replace"))
            self.known[u] = out if out.count(LOST) <= self.lost * len(out) else u
        return self.known[u]

    def __call__(self, s: str) -> str:
        return self.run.sub(self._text, s) if self.shows.search(s) else s


class _OneByte:
    """A one-byte page shown as another: a table for translate()."""

    def __init__(self, true: str, shown: str):
        self.name = f"{true} as {shown}"
        self.cyrillic = "Я" in _shown(true)
        t, s = _shown(true), _shown(shown)
        self.table = {ord(s[b]): t[b] for b in range(255, 0x7F, -1)}
        if shown == "cp1252":
            self.table |= {b: t[b] for b in range(0x80, 0xA0)}

    def __call__(self, s: str, high: int | None = None) -> str:
        high = len(s) - len(s.encode("ascii", "ignore")) if high is None else high
        # a Cyrillic text is mostly above ASCII, a Latin one hardly
        fits = high >= LEAST_LETTERS and (5 * high >= 2 * (len(s) - s.count(" ")) if self.cyrillic else 4 * high <= len(s))
        return s.translate(self.table) if fits else s


@lru_cache(1)
def swaps() -> list:
    utf = [_Utf8In(p) for p in UTF8_IN]
    return [*utf, _Twice(utf[0]), _RunSwap("utf_8", "gbk", 0.2), _RunSwap("gbk", "cp1252", 0.1), *(_OneByte(a, b) for a, b in ONE_BYTE)]


class PairCounts:
    """Adds up how often each pair of characters stands in a text."""

    LOW = 1280  # pairs of characters below this are counted in an array

    def __init__(self):
        self.low = np.zeros(self.LOW * self.LOW, np.int64)
        self.keys, self.counts, self.held = [], [], 0

    def add(self, cps: np.ndarray, times: np.ndarray | int = 1) -> None:
        if len(cps) < 2:
            return
        cps = np.minimum(cps, TOP - 1).astype(np.int64)
        a, b = cps[:-1], cps[1:]
        low = (a < self.LOW) & (b < self.LOW)
        at = a[low] * self.LOW + b[low]
        high = ~low
        key = (a[high] << 21) | b[high]
        if isinstance(times, int):
            self.low += times * np.bincount(at, minlength=len(self.low))
            k, n = np.unique(key, return_counts=True)
            n = n * times
        else:
            self.low += np.bincount(at, times[low], len(self.low)).astype(np.int64)
            k, i = np.unique(key, return_inverse=True)
            n = np.bincount(i, times[high], len(k)).astype(np.int64)
        self.keys.append(k)
        self.counts.append(n)
        self.held += len(k)
        if self.held > 4_000_000:
            self._merge()

    def _merge(self) -> None:
        k, i = np.unique(np.concatenate(self.keys), return_inverse=True)
        self.keys, self.counts = [k], [np.bincount(i, np.concatenate(self.counts), len(k)).astype(np.int64)]
        self.held = 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) so far."""
        if self.keys:
            self._merge()
        at = np.flatnonzero(self.low)
        k = np.concatenate([((at // self.LOW) << 21) | (at % self.LOW), *self.keys])
        return k, np.concatenate([self.low[at], *self.counts])


def _slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a.astype(np.uint32) * np.uint32(0x9E3779B1) ^ (b.astype(np.uint32) * np.uint32(0x85EBCA6B) + np.uint32(0x165667B1))
    h ^= h >> np.uint32(15)
    return h & np.uint32((1 << HASH_BITS) - 1)


class Bigrams:
    """log P(next character | character), backed off to single characters; unseen pairs score as independent.

    Counts come as arrays: of single characters, and of pairs with their keys (first << 21 | second). A pair counts as seen from LEAST_PAIR of all
    pairs on, whatever the size of the corpus, or between ASCII characters."""

    def __init__(self, uni: np.ndarray, keys: np.ndarray, counts: np.ndarray, smooth: float = 2.0):
        n = max(float(uni.sum()), 1.0)
        p = np.log((uni + 0.01) / (n + 0.01 * TOP))
        self.after = np.maximum(p, -15).astype(np.float16)
        self.before = np.log(smooth / (uni + smooth)).astype(np.float16)
        a, b = keys >> 21, keys & 0x1FFFFF
        self.table = np.full(1 << HASH_BITS, np.nan, np.float16)
        keep = (counts >= max(2.0, LEAST_PAIR * n)) | ((a < 128) & (b < 128) & (counts > 0))
        a, b, counts = a[keep], b[keep], counts[keep]
        order = np.argsort(counts, kind="stable")  # where two pairs share a slot, the more frequent one has it
        self.table[_slots(a[order], b[order])] = np.log((counts + smooth * np.exp(p[b])) / (uni[a] + smooth))[order]

    @classmethod
    def of_lines(cls, lines: list[str]) -> "Bigrams":
        t = PairCounts()
        t.add(np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32))
        keys, counts = t.take()
        return cls(np.bincount(keys >> 21, counts, TOP), keys, counts)

    def scores(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-probability of each pair, whether it is unseen)."""
        cps = np.minimum(cps, TOP - 1)
        a, b = cps[:-1], cps[1:]
        s = self.table[_slots(a, b)].astype(np.float32)
        unseen = np.isnan(s)
        if unseen.any():
            s[unseen] = self.before[a[unseen]].astype(np.float32) + self.after[b[unseen]]
        return s, unseen

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        s = self.table[_slots(a, b)].astype(np.float32)
        new = np.isnan(s)
        if new.any():
            s[new] = self.before[a[new]].astype(np.float32) + self.after[b[new]]
        return s

    def unseen(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.isnan(self.table[_slots(a, b)])

    def total(self, s: str) -> float:
        cps = np.minimum(np.frombuffer(("\n" + s + "\n").encode("utf-32-le"), np.uint32), TOP - 1)
        return float(self.of_pairs(cps[:-1], cps[1:]).sum())


def suspicious(lm: Bigrams, cps: np.ndarray) -> np.ndarray:
    """Weight of each pair as a sign of a wrong decoding; a line or value is suspicious from 3 on.

    3: U+FFFD, a very rare character, or an unseen pair of two characters above ASCII; 1: an unseen pair of
    Cyrillic letters or of ideographs of which one is rare (names make such pairs now and then); 0: any other."""
    w = np.zeros(max(len(cps) - 1, 0), np.int64)
    at = np.flatnonzero(cps[1:] > 127)  # only these can weigh anything
    if not len(at):
        return w
    a, b = np.minimum(cps[at], TOP - 1), np.minimum(cps[at + 1], TOP - 1)
    unseen = lm.unseen(a, b)
    rare = lambda c: lm.after[c] < -14
    han = lambda c: (c >= 0x3400) & (c < 0xA000)
    cyr = lambda c: (c >= 0x400) & (c < 0x460)
    on = np.flatnonzero(unseen | (b == 0xFFFD))
    if not len(on):
        return w
    at, a, b = at[on], a[on], b[on]
    ha, hb = han(a), han(b)
    both = a > 127
    v = np.where(both, 3, 0)
    v[both & cyr(a) & cyr(b)] = 1
    v[both & ha & hb] = np.where(rare(a) | rare(b), 1, 0)[both & ha & hb]
    v[both & (ha ^ hb)] = 1
    v[(rare(b) & ~hb) | (b == 0xFFFD)] = 3
    w[at] = v
    return w


class Decoder:
    """Finds and restores wrongly decoded lines; small enough to travel with a task (about 5 MB)."""

    def __init__(self, lm: Bigrams, least_gain: float = 16.0):
        self.lm, self.least = lm, least_gain
        self.memo: dict[str, tuple] = {}

    def __getstate__(self):
        return {"lm": self.lm, "least": self.least, "memo": {}}

    def is_suspicious(self, s: str) -> bool:
        if s.isascii():
            return False
        return int(suspicious(self.lm, np.frombuffer(("\n" + s + "\n").encode("utf-32-le"), np.uint32)).sum()) >= 3

    def gains(self, s: str, least: float | None = None) -> list[tuple[int, float, str]]:
        """(swap, gain in log-probability, decoded) of every swap that gains. A decoded text with fewer characters has fewer factors, so gains are compared per shown character with a floor per saved one."""
        base = None
        high = len(s) - len(s.encode("ascii", "ignore"))
        out = []
        for k, f in enumerate(swaps()):
            t = f(s, high) if isinstance(f, _OneByte) else f(s)
            if t == s:
                continue
            base = self.lm.total(s) if base is None else base
            saved = len(s) - len(t)
            g = self.lm.total(t) - base - 2.0 * saved - 6.0 * (t.count(LOST) - s.count(LOST) if LOST in t else 0)
            if g > (self.least if least is None else least):
                out.append((k, g, t))
        return out

    def read(self, s: str) -> str | None:
        """A line as the EM counts it: decoded where a swap doesn't lose by more than the garbled pairs that the model still holds may cost, None where characters are lost and none does."""
        t = self._first(s, -2.0, lambda t: not _tried_of(np.frombuffer(t.encode("utf-32-le"), np.uint32), np.array([0, len(t)])))
        return None if t == s and LOST in s else t

    def best(self, s: str) -> str:
        """A suspicious line restored by the first swap, in their order, that gains and leaves nothing suspicious, else by that of the highest gain."""
        return self._first(s, self.least, lambda t: not self.is_suspicious(t))

    def _first(self, s: str, least: float, clean) -> str:
        base, best = None, (least, s)
        high = len(s) - len(s.encode("ascii", "ignore"))
        for f in swaps():
            t = f(s, high) if isinstance(f, _OneByte) else f(s)
            if t == s:
                continue
            base = self.lm.total(s) if base is None else base
            g = self.lm.total(t) - base - 2.0 * (len(s) - len(t)) - 6.0 * (t.count(LOST) - s.count(LOST) if LOST in t else 0)
            if g > best[0]:
                best = (g, t)
                if LOST not in t and clean(t):
                    break
        return best[1]

    def line(self, s: str) -> tuple[str, list[tuple[int, float]]]:
        """(the line restored by its best swap, all gaining swaps)."""
        if s.isascii():
            return s, []
        hit = self.memo.get(s)
        if hit is None:
            hit = (s, [])
            if self.is_suspicious(s) and (g := self.gains(s)):
                best = max(g, key=lambda x: x[1])
                hit = (best[2], [(k, v) for k, v, _ in g])
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[s] = hit
        return hit

    def text(self, s: str) -> str:
        """The whole text, each suspicious line restored by best()."""
        if s.isascii():
            return s
        return "\n".join(x if x.isascii() or not self.is_suspicious(x) else self.best(x) for x in s.split("\n"))

    def texts(self, values: list[str | None]) -> list[str]:
        """text() of many values, looking line by line only into those that hold something suspicious; null gives ''."""
        out = [v or "" for v in values]
        for i in np.flatnonzero(self.suspicious_rows(pa.array(out, pa.string()))):
            out[i] = self.text(out[i])
        return out

    def suspicious_rows(self, col) -> np.ndarray:
        """Rows of an Arrow column that hold a suspicious pair, found for the whole batch at once."""
        cps, offs = code_points(col)
        if len(cps) < 2:
            return np.zeros(len(offs) - 1, np.bool_)
        w = suspicious(self.lm, cps)
        at = np.flatnonzero(w)
        row = np.searchsorted(offs, at + 1, side="right") - 1
        inside = at >= offs[row]
        return np.bincount(row[inside], w[at[inside]], len(offs) - 1) >= 3


def fit_lines(texts: list[str | None], rounds: int = 2) -> Decoder:
    """The same hard EM as fit() over the lines of a few texts in memory."""
    lines = list({x: None for t in texts if t for x in t.split("\n") if x})
    dec = Decoder(Bigrams.of_lines(lines))
    for _ in range(rounds):
        tried = set(_tried(pa.array(lines, pa.string())))
        dec = Decoder(Bigrams.of_lines([y for x in lines if (y := dec.read(x) if x in tried else x) is not None]))
    return dec


def _classes() -> np.ndarray:
    """1, 2: Latin letters above ASCII, small and capital; 3, 4: Cyrillic ones; 5: signs above ASCII that don't stand beside letters in clean text;
    6: ideographs outside the 3,755 common ones (the first level of GB 2312); 7: the common ones."""
    global _class_table
    if _class_table is None:
        t = np.zeros(TOP, np.uint8)
        for c in range(0x80, 0x3000):
            k = unicodedata.category(chr(c))
            if 0x400 <= c < 0x530:
                t[c] = 4 if k == "Lu" else 3
            elif k[0] == "L" and c < 0x250 and chr(c) not in "ªº":
                t[c] = 2 if k == "Lu" else 1
            elif k[0] != "M" and chr(c) not in USUAL_SIGNS:
                t[c] = 5
        t[0x3400:0xA000] = 6
        for lead in range(0xB0, 0xD8):
            for c in b"".join(bytes([lead, trail]) for trail in range(0xA1, 0xFF)).decode("gb2312", "ignore"):
                t[ord(c)] = 7
        _class_table = t
    return _class_table


_class_table: np.ndarray | None = None


def _tried(col) -> list[str]:
    """Lines of an Arrow column whose make-up says that they may be wrongly decoded, however often their pairs occur. Rare garbled pairs needn't be
    found here: they stay too rare to count as seen."""
    return _tried_of(*code_points(col))


def _tried_of(cps: np.ndarray, offs: np.ndarray) -> list[str]:
    """_tried() of rows as code points and the rows' bounds."""
    if len(cps) < 2 or not (cps > 127).any():
        return []
    cps = np.minimum(cps, TOP - 1)
    start = cps == 10
    start[offs[1:-1][offs[1:-1] < len(cps)]] = True  # a line feed belongs to the line after it, and is stripped
    line = np.cumsum(start)
    n = line[-1] + 1
    high = np.flatnonzero(cps > 127)
    own = line[high]
    k = _classes()[cps[high]]
    both = np.flatnonzero((np.diff(high) == 1) & (own[:-1] == own[1:]))
    a, b = k[both], k[both + 1]
    letter = lambda x: (x > 0) & (x < 5)
    odd = np.where((letter(a) & (b == 5)) | ((a == 5) & letter(b)) | ((a == 5) & (b == 5) & (cps[high[both]] != cps[high[both + 1]])), 2, 0)
    odd[((a == 1) & (b == 1)) | ((a == 2) & (b == 2)) | ((a == 3) & (b == 4))] = 1
    hits = np.bincount(own[both], odd, n) >= 2
    few = np.bincount(own[k == 6], minlength=n)
    hits |= (few >= 4) & (4 * few >= np.bincount(own[k >= 6], minlength=n))
    hits |= np.bincount(own[cps[high] == 0xFFFD], minlength=n) > 0
    if not hits.any():
        return []
    first = np.searchsorted(line, np.flatnonzero(hits))
    last = np.searchsorted(line, np.flatnonzero(hits), side="right")
    return [x for i, j in zip(first, last) if (x := cps[i:j].astype("<u4").tobytes().decode("utf-32-le").strip("\n"))]


_PAIRS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
_FOUND = pa.schema([*_PAIRS, ("line", pa.string())])


def fit(texts: DataFrame, rounds: int = 1) -> Decoder:
    """Hard EM over all distinct texts: lines that may be wrongly decoded are decoded by the present model, and the model is counted again.

    texts: (text) as corpus.texts() gives them. Pairs are counted in every task first; only pairs that are frequent enough to count as seen, at most
    1 / LEAST_PAIR whatever the corpus, and the single characters come to the driver. Lines that may be garbled are found once, and
    each round counts only what they change."""

    def counted(it):
        t = PairCounts()
        for b in batches(it, ["text"], 4 << 20):
            t.add(np.frombuffer("\n".join(["", *b.column(0).to_pylist(), ""]).encode("utf-32-le"), np.uint32))
            lines = _tried(b.column(0))
            if lines:
                none = pa.nulls(len(lines), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(lines, pa.string())], schema=_FOUND)
        keys, counts = t.take()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.nulls(len(keys), pa.string())], schema=_FOUND)

    # one pass gives both the pairs, added up a task, and the lines, added up by Spark
    found = texts.select("text").mapInArrow(counted, "pair long, n long, line string")
    found = cut(found.groupBy("pair", "line").agg(F.sum("n").alias("n"), F.count("*").alias("times")))
    base = found.where("line is null").select("pair", "n")
    lines = found.where("line is not null").select("line", F.col("times").alias("n")).repartition(texts.sparkSession.sparkContext.defaultParallelism)

    def model(pairs: DataFrame) -> Bigrams:
        one = pairs.groupBy(F.shiftright("pair", 21).cast("int").alias("c")).agg(F.sum("n").alias("n")).toArrow()
        uni = np.zeros(TOP)
        uni[np.asarray(one["c"])] = np.maximum(np.asarray(one["n"]), 0)
        least = max(2.0, LEAST_PAIR * uni.sum())
        seen = pairs.where((F.col("n") >= least) | ((F.col("pair") < 128 << 21) & (F.col("pair").bitwiseAND(0x1FFFFF) < 128))).toArrow()
        return Bigrams(uni, np.asarray(seen["pair"]), np.asarray(seen["n"]).astype(np.float64))

    lm = model(base)
    for first in [True] + [False] * (rounds - 1):  # once the garbled pairs have left the model, it finds these lines by itself
        dec = Decoder(lm)

        def changed(it, dec=dec, first=first):
            t = PairCounts()
            for b in it:
                old_new = [(f"\n{x}\n", f"\n{y}\n" if y is not None else "", n) for x, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (first or dec.is_suspicious(x)) and (y := dec.read(x)) != x]
                for i, sign in ((0, -1), (1, 1)):
                    cps = np.frombuffer("".join(p[i] for p in old_new).encode("utf-32-le"), np.uint32)
                    times = np.repeat([sign * p[2] for p in old_new], [len(p[i]) for p in old_new]).astype(np.int64)
                    t.add(cps, times[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in t.take()], schema=_PAIRS)

        lm = model(cut(base.unionByName(lines.mapInArrow(changed, "pair long, n long")).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")))
    return Decoder(lm)


# ---------------------------------------------------------------- the cipher of each source

#: Name of the cipher that starts from no code page.
FREE = "unknown page"
#: Weight of the mapping pooled over all sources, in letters, against a source's own.
POOLED = 20.0
#: Share of a shown character's occurrences that must stand for one letter.
SURE = 0.5


def _one_byte() -> dict[str, _OneByte]:
    return {f.name: f for f in swaps() if isinstance(f, _OneByte)}


class Cipher:
    """Learns the mapping from shown characters to letters from counts of shown pairs, by EM against the bigram model.

    A pair (a, b) is shown for letters (x, y) with P(x, y) E(a | x) E(b | y), E being what is learnt; ASCII stands for itself. Everything is
    a product of matrices, shown characters by letters."""

    def __init__(self, lm: Bigrams):
        at = np.flatnonzero(lm.after[:0x3000] > -11.5)
        self.letters = np.unique(np.concatenate([[10], np.arange(32, 127), at[at > 127]]))
        x = np.repeat(self.letters, len(self.letters))
        y = np.tile(self.letters, len(self.letters))
        p = np.exp(lm.after[self.letters].astype(np.float64))
        self.pair = p[:, None] * np.exp(lm.of_pairs(x, y).astype(np.float64)).reshape(len(p), len(p))
        self.prior = p / p.sum()

    def learn(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, starts: list[dict[int, dict[int, float]]], rounds: int = 40) -> dict[int, dict[int, float]]:
        """{shown: {letter: share}} of the start that explains the pairs best. A start gives shares of letters for shown characters, with a weight of POOLED letters in
        every round if it is the only one; a shown character it doesn't know may be any letter."""
        shown = np.unique(np.concatenate([a, b]))
        i, j = np.searchsorted(shown, a), np.searchsorted(shown, b)
        counts = np.zeros((len(shown), len(shown)))
        np.add.at(counts, (i, j), n)
        fixed = (shown < 128) & np.isin(shown, self.letters)
        own = np.searchsorted(self.letters, np.minimum(shown, self.letters[-1]))
        high = self.letters > 127
        best = None
        for start in starts:
            share = np.tile(np.where(high, self.prior, 0.0), (len(shown), 1)) * 0.2
            for k, c in enumerate(shown):
                if fixed[k]:
                    share[k] = 0.0
                    share[k, own[k]] = 1.0
                for x, v in start.get(int(c), {}).items():
                    if not fixed[k] and x in self.letters:
                        share[k, np.searchsorted(self.letters, x)] += v
            prior = share / share.sum(axis=1, keepdims=True) * (POOLED if len(starts) == 1 else 1.0)
            seen = counts.sum(axis=0) + counts.sum(axis=1)
            c = share / share.sum(axis=1, keepdims=True) * (seen[:, None] + 1)
            for _ in range(rounds):
                e = c / (c.sum(axis=0) + 1.0)  # E(shown | letter)
                e[fixed] = np.where(share[fixed] > 0, 1.0, 0.0)
                right = e @ self.pair.T
                left = e @ self.pair
                z = np.maximum(right @ e.T, 1e-300).T  # z[a, b] = sum over x, y of E(a|x) P(x, y) E(b|y)
                r = counts / z
                c = e * (r @ right + r.T @ left) + np.where(high, prior, 0.0) * ~fixed[:, None]
            score = float((counts * np.log(z)).sum())
            if best is None or score > best[0]:
                best = (score, c / np.maximum(c.sum(axis=1, keepdims=True), 1e-300))
        out = {}
        for k, v in enumerate(shown):
            if not fixed[k] and v > 127 and best is not None:
                top = np.argsort(-best[1][k])[:4]
                out[int(v)] = {int(self.letters[t]): float(best[1][k, t]) for t in top}
        return out

    def starts(self, name: str) -> list[dict[int, dict[int, float]]]:
        """A listed page starts from its table; the unknown one from each page in turn, and from how frequent letters are."""
        of = lambda f: {c: {ord(x): 1.0} for c, x in f.table.items() if c > 127 and len(x) == 1}
        known = _one_byte()
        return [of(known[name])] if name in known else [*map(of, known.values()), {}]

    def by_frequency(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, seed: int) -> dict[int, dict[int, float]]:
        """A start for an unknown page of a script that is mostly above ASCII: shown characters and small letters of the script, both in order of frequency, shaken."""
        seen: dict[int, float] = {}
        for c, v in zip(np.concatenate([a, b]), np.concatenate([n, n])):
            if c > 127:
                seen[int(c)] = seen.get(int(c), 0.0) + float(v)
        small = [x for x in self.letters if 0x430 <= x < 0x450]
        rng = np.random.default_rng(seed)
        order = sorted(seen, key=lambda c: -np.log(seen[c]) + 0.4 * seed * rng.random())
        rank = sorted(small, key=lambda x: -self.prior[np.searchsorted(self.letters, x)])
        return {c: {int(rank[q]): np.exp(-abs(k - q) / 2.0) for q in range(max(0, k - 6), min(len(rank), k + 7))} for k, c in enumerate(order) if k < len(rank) + 6}


_CAND = "array<struct<no:int,line:string,cand:array<struct<swap:int,gain:double>>>>"


def suspects(texts: DataFrame, decoder: Decoder) -> DataFrame:
    """(kind, h, g, text, lost, lines) of the texts with suspicious lines: these lines with the swaps that gain in them."""
    cand = pa.list_(pa.struct([("no", pa.int32()), ("line", pa.string()), ("cand", pa.list_(pa.struct([("swap", pa.int32()), ("gain", pa.float64())])))]))
    shape = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("g", pa.int64()), ("text", pa.string()), ("lost", pa.bool_()), ("lines", cand)])

    def run(it):
        for b in batches(it, ["text"], 4 << 20):
            out = []
            for r in b.take(pa.array(np.flatnonzero(decoder.suspicious_rows(b.column(3))))).to_pylist():
                lines = [{"no": i, "line": x, "cand": [{"swap": k, "gain": v} for k, v in decoder.line(x)[1]]} for i, x in enumerate(r["text"].split("\n")) if decoder.is_suspicious(x)]
                out.append({**r, "lost": LOST in r["text"], "lines": lines})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=shape)

    return texts.select("kind", *KEY, "text").mapInArrow(run, f"kind int, h long, g long, text string, lost boolean, lines {_CAND}")


def swap_weights(lines: DataFrame, rounds: int = 3, prior: float = 0.5) -> DataFrame:
    """(source, swap, weight): how likely each swap is in each source, by EM over (source, id, swap, gain) of the suspicious lines.

    Each round is one aggregation by source and swap with map-side sums, whatever the size of a source."""
    pi = None
    for _ in range(rounds):
        e = lines.withColumn("w", F.lit(0.0)) if pi is None else lines.join(pi, ["source", "swap"], "left").withColumn("w", F.log("weight"))
        one = Window.partitionBy("source", "id")
        e = e.withColumn("s", F.col("gain") + F.col("w")).withColumn("s", F.exp(F.greatest(F.col("s") - F.max("s").over(one), F.lit(-60.0))))
        e = e.withColumn("post", F.col("s") / F.sum("s").over(one))
        n = e.groupBy("source", "swap").agg(F.sum("post").alias("n"))
        pi = n.withColumn("weight", (F.col("n") + prior) / (F.sum("n").over(Window.partitionBy("source")) + prior * len(swaps()))).select("source", "swap", "weight")
        pi = cut(pi)
    return pi


def _choice(cand: list[dict], weight: dict[int, float]) -> tuple[int, float] | None:
    """The swap of the highest posterior and its gain."""
    if not cand:
        return None
    least = 0.5 / len(swaps())
    best = max(cand, key=lambda c: (c["gain"] + np.log(weight.get(c["swap"], least)), -c["swap"]))
    return best["swap"], best["gain"]


def _cipher_of(cand: list[dict], weight: dict[int, float]) -> str | None:
    """The cipher whose mapping a line helps to learn: that of its one-byte page, or the unknown one where no page gains. None for units of several characters."""
    best = _choice(cand, weight)
    if best is None:
        return FREE
    f = swaps()[best[0]]
    return f.name if isinstance(f, _OneByte) else None


def _shown_pairs(line: str) -> tuple[np.ndarray, np.ndarray]:
    cps = np.frombuffer(f"\n{line}\n".encode("utf-32-le"), np.uint32).astype(np.int64)
    a, b = cps[:-1], cps[1:]
    keep = ((a > 127) | (b > 127)) & (a < 0x3000) & (b < 0x3000)
    return a[keep], b[keep]


def mappings(by_source: DataFrame, decoder: Decoder) -> DataFrame:
    """(source, ciphers map<cipher, map<shown, letter>>): the mapping of each source's one-byte ciphers.

    by_source: (source, lines, weights). Pairs of shown characters are added up per source and cipher; the EM of a cipher runs over all sources first, and
    from there over each source. A group holds one row per pair of shown characters, whatever its source holds."""
    lm = decoder.lm

    def counted(it):
        for batch in it:
            n: dict[tuple, int] = {}
            for r in batch.to_pylist():
                weight = dict(r["weights"] or [])
                for x in r["lines"]:
                    name = _cipher_of(x["cand"], weight)
                    if name and LOST not in x["line"]:
                        for a, b in zip(*_shown_pairs(x["line"])):
                            k = (r["source"], name, int(a), int(b))
                            n[k] = n.get(k, 0) + 1
            if n:
                cols = list(zip(*n))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(list(n.values()), pa.int64())], names=["source", "cipher", "a", "b", "n"])

    counts = cut(by_source.mapInArrow(counted, "source string, cipher string, a int, b int, n long").groupBy("source", "cipher", "a", "b").agg(F.sum("n").alias("n")))
    shape = "source string, cipher string, shown int, letter int, share double"

    def rows(source: str, cipher: str, table: dict[int, dict[int, float]]) -> pd.DataFrame:
        return pd.DataFrame([(source, cipher, c, x, v) for c, t in table.items() for x, v in t.items()], columns=["source", "cipher", "shown", "letter", "share"])

    def over_all(keys: tuple, g: pd.DataFrame) -> pd.DataFrame:
        t = Cipher(lm)
        a, b, n = (g[c].to_numpy() for c in ("a", "b", "n"))
        starts = t.starts(keys[0])
        if keys[0] == FREE:
            starts += [t.by_frequency(a, b, n, s) for s in range(12)]
        return rows("", keys[0], t.learn(a, b, n, starts))

    every = counts.groupBy("cipher", "a", "b").agg(F.sum("n").alias("n"))
    pooled: dict[str, dict[int, dict[int, float]]] = {}
    for r in every.groupBy("cipher").applyInPandas(over_all, shape).collect():  # four letters at most for each shown character of a cipher
        pooled.setdefault(r.cipher, {}).setdefault(r.shown, {})[r.letter] = r.share

    def of_source(keys: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return rows(keys[0], keys[1], Cipher(lm).learn(g["a"].to_numpy(), g["b"].to_numpy(), g["n"].to_numpy(), [pooled.get(keys[1], {})], 15))

    own = counts.groupBy("source", "cipher").applyInPandas(of_source, shape)
    best = own.groupBy("source", "cipher", "shown").agg(F.max_by("letter", F.struct("share", "letter")).alias("letter"), F.max("share").alias("share")).where(F.col("share") >= SURE)
    tables = best.groupBy("source", "cipher").agg(F.map_from_entries(F.collect_list(F.struct("shown", "letter"))).alias("t"))
    return cut(tables.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("cipher", "t"))).alias("ciphers")))


def readings(by_source: DataFrame, decoder: Decoder) -> DataFrame:
    """(source, kind, h, g, swap, gain, lost, restored) of the texts that are wrongly decoded.

    Each suspicious line is read by the swap of its highest posterior: with translate() by the mapping learnt for its source where characters stand for single
    bytes, by the swap's units otherwise. A line without a swap is read by the source's unknown cipher if that gains enough."""
    shape = pa.schema([("source", pa.string()), ("kind", pa.int32()), ("h", pa.int64()), ("g", pa.int64()), ("swap", pa.string()), ("gain", pa.float64()), ("lost", pa.bool_()), ("restored", pa.string())])
    lm = decoder.lm

    def run(it):
        for batch in it:
            out = []
            for r in batch.to_pylist():
                weight = dict(r["weights"] or [])
                tables = {k: dict(t) for k, t in (r["ciphers"] or [])}
                text = r["text"].split("\n")
                total: dict[str, float] = {}
                for x in r["lines"]:
                    s, best = x["line"], _choice(x["cand"], weight)
                    name = _cipher_of(x["cand"], weight)
                    gain, read = (best[1], swaps()[best[0]](s)) if best else (0.0, s)
                    if name in tables:
                        t = s.translate(tables[name])
                        better = lm.total(t) - lm.total(s)
                        if better > (lm.total(read) - lm.total(s) if best else decoder.least):
                            gain, read = better, t
                    if gain >= decoder.least:
                        label = name or swaps()[best[0]].name
                        total[label] = total.get(label, 0.0) + gain
                        text[x["no"]] = read
                if total or r["lost"]:
                    top = max(total, key=lambda k: (total[k], k)) if total else None
                    out.append({**{k: r[k] for k in ("source", "kind", "h", "g", "lost")}, "swap": top, "gain": total[top] if top else 0.0, "restored": "\n".join(text)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=shape)

    return by_source.mapInArrow(run, "source string, kind int, h long, g long, swap string, gain double, lost boolean, restored string")


def garbled_texts(records: DataFrame, texts: DataFrame, decoder: Decoder) -> tuple[DataFrame, DataFrame]:
    """(readings of the wrongly decoded texts of each source, keys of the records' texts with their uid, source and whether the content begins with the source text)."""
    begins = F.coalesce((F.col("style") == "qa") & F.startswith("content", F.coalesce("_source_text", F.lit(""))), F.lit(False)).alias("begins")
    keys = keyed(records, "uid", F.coalesce("source", F.lit("")).alias("source"), "style", begins).dropDuplicates(["uid", "kind"])
    found = cut(suspects(texts, decoder))
    by = found.join(keys.select("source", "kind", *KEY).distinct(), ["kind", *KEY])
    lines = by.select("source", "kind", *KEY, F.explode("lines").alias("x")).select("source", F.struct("kind", *KEY, "x.no").alias("id"), F.explode("x.cand").alias("c")).select("source", "id", "c.*")
    pi = swap_weights(lines).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("swap", "weight"))).alias("weights"))
    by = by.join(pi, "source", "left")
    tables = mappings(by.select("source", "lines", "weights"), decoder)
    return readings(by.join(tables, "source", "left"), decoder), keys


def affected(records: DataFrame, texts: DataFrame, decoder: Decoder) -> DataFrame:
    """(uid, source, field, swap, gain, lost, parts) of every wrongly decoded value, parts being (kind, restored) of its wrongly decoded texts.

    The content of a qa record has two: its source text, where it begins with it, and what follows. swap is null where only lost characters (U+FFFD)
    show it. Null and empty values have no row; a record delivered twice has one."""
    read, keys = garbled_texts(records, texts, decoder)
    r = keys.join(read, ["source", "kind", *KEY])
    fields = F.when(F.col("kind") != SOURCE, F.array(F.lit("content"))).when(F.col("begins"), F.array(F.lit("_source_text"), F.lit("content"))).otherwise(F.array(F.lit("_source_text")))
    r = r.withColumn("field", F.explode(fields))
    return r.groupBy("uid", "source", "field").agg(F.max_by("swap", F.struct("gain", "swap")).alias("swap"), F.sum("gain").alias("gain"), F.max("lost").alias("lost"), F.map_from_entries(F.collect_list(F.struct("kind", "restored"))).alias("parts"))


def garbled(records: DataFrame, texts: DataFrame, decoder: Decoder) -> DataFrame:
    """(uid, source, field, swap, gain, restored, lost): affected() with each value as it was, as far as that is possible."""
    a = affected(records, texts, decoder)
    part = lambda k, own: F.coalesce(F.try_element_at("parts", F.lit(k)), own)
    body = body_of()
    begins = (F.col("style") == "qa") & F.startswith("content", F.coalesce("_source_text", F.lit("")))
    whole = F.when(F.col("field") == "_source_text", part(SOURCE, F.col("_source_text"))).when(F.col("style") != "qa", part(REWRITE, F.col("content")))
    whole = whole.when(begins, F.concat(part(SOURCE, F.coalesce("_source_text", F.lit(""))), part(BODY, body))).otherwise(part(BODY, F.col("content")))
    values = records.select("uid", F.coalesce("style", F.lit("")).alias("style"), "_source_text", "content").dropDuplicates(["uid"])
    return a.join(values, "uid").select("uid", "source", "field", "swap", "gain", whole.alias("restored"), "lost")
