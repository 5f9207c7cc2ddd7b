"""Problem 5: page furniture around and inside the main text.

Method: tag-path ratios. The texts come as lines without markup, so a line's path is what a template leaves:
its marker, its opening words (inner node), its closing words, and the line with digits masked (leaf).
Over the whole corpus each path gets its number of texts, the text length and punctuation that hang on it, how
often it stands as a title (over a long line, under no prose), and how often rewrites, which have no furniture,
hold it. Paths with little text and punctuation that rewrites never hold are furniture paths. Paths are folded
into a fixed number of buckets, so the statistics and what is sent to tasks are bounded for any corpus. Per
text the path verdicts are fused with the lines around them: entries under a sidebar heading or in a run of
entries go with it, a short line over the body is its title.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import corpus
from .arrowtext import batches
from .codepages import Decoder
from .corpus import BODY, KEY, REWRITE, SOURCE

#: Buckets are 2 to this power, so that few paths share one; a verdict takes one bit, 2 MB for all.
BITS = 24
#: Texts that a path must occur in, and its least share of source texts against rewrites.
LEAST_TEXTS, LEAST_SHARE = 4, 0.9
#: Text length per line up to which a path can be furniture, and most of its lines that may stand as a title.
MOST_LENGTH, MOST_TITLE = 110.0, 0.04
#: What full stops add to the length ratio: a path whose lines all end in one may be this much shorter.
STOP_WEIGHT = 0.1
CLOSERS = "\"'”»“’）)」』】]"
STOPS = (".", "!", "?", "。", "！", "？", "…", "।")
MARKER = re.compile(r"^\s*(?:([-*•>▪◦·–])|(\d{1,3}[.)、])|(\([a-zA-Z0-9]{1,3}\)))\s*")
DIGITS = re.compile(r"\d+")
HAN = re.compile(r"[㐀-鿿]")
SPLIT = re.compile(r"\s*(?:[|·>/;,\t]|\s{2,})\s*")
#: What a line has that SPLIT can split.
SEPARATOR = re.compile(r"[|·>/;,\t]|\s\s")


def is_han(s: str) -> bool:
    return not s.isascii() and len(HAN.findall(s)) * 3 > len(s)


def closed(s: str) -> bool:
    """Ends with a full stop, whatever quotes or brackets follow it."""
    return s.rstrip().rstrip(CLOSERS).endswith(STOPS)


def weight(s: str) -> int:
    """Characters, an ideograph counting for three."""
    return len(s) if s.isascii() else len(s) + 2 * len(HAN.findall(s))


@lru_cache(64)
def _begun(kind: str) -> int:
    return zlib.crc32(f"{kind}\x00".encode())


def bucket(kind: str, key: str) -> int:
    return zlib.crc32(key.encode(), _begun(kind)) & ((1 << BITS) - 1)


def paths(line: str, ideographs: int | None = None) -> list[tuple[str, int]]:
    """(node, bucket) of a line: leaf, opening and closing. Marks of lists are no part of the words. ideographs: how many the line has, where they are counted already."""
    m = MARKER.match(line)
    s = DIGITS.sub("0", line[m.end() :] if m else line).strip()
    out = [("leaf", bucket("leaf", s))]
    if is_han(s) if ideographs is None else 3 * ideographs > len(s):  # no mark and no digit is an ideograph
        if len(s) >= 7:
            out += [("open", bucket("open", s[:4])), ("close", bucket("close", s[-5:]))]
    else:
        w = s.split(None, 2)
        if len(w) == 3:
            out += [("open", bucket("open", f"{w[0]} {w[1]}")), ("close", bucket("close", " ".join(s.rsplit(None, 2)[1:])))]
    return out


def bitmaps(df: DataFrame, bucket: str, marks: dict[str, Column]) -> dict[str, np.ndarray]:
    """One bit per bucket and mark, as bytes: set where the mark holds for a row of the bucket.

    Bits are put together in words of 64 before they leave the executors, so the driver gets 2^18 short rows at most."""
    bit = F.expr(f"shiftleft(1L, cast({bucket} % 64 as int))")
    words = df.groupBy(F.expr(f"cast({bucket} div 64 as int)").alias("_w")).agg(*[F.bit_or(F.when(m, bit).otherwise(F.lit(0).cast("long"))).alias(n) for n, m in marks.items()]).toArrow()
    out = {}
    for n in marks:
        full = np.zeros(1 << (BITS - 6), np.int64)
        full[np.asarray(words["_w"])] = np.asarray(words[n])
        out[n] = full.astype("<i8").view(np.uint8)
    return out


def on(bits: np.ndarray, k: int) -> bool:
    return bool(bits[k >> 3] >> (k & 7) & 1)


def path_statistics(texts: DataFrame, more=None) -> DataFrame:
    """(node, bucket, texts, length, stops, titles, rewrites) of every path bucket, over all distinct source texts and rewrites.

    texts: (kind, text) of corpus.texts, so a text counts once, wherever its copies lie. Tasks add up their own counts first. `more(text, kind)` may
    give further (node, key) to be counted in the same pass; bodies of qa records are read only for `more`.
    Wrongly decoded lines count as they stand: their verdict is asked for as restored."""
    shape = pa.schema([("b", pa.int64()), ("node", pa.string()), *[(c, pa.int64()) for c in ("texts", "length", "stops", "titles", "rewrites")]])

    def run(it):
        total: dict[tuple[int, str], list[int]] = {}
        for b in batches(it, ["text"], 4 << 20):
            values = b.column(0).to_pylist()
            han = line_ideographs(values)
            for text, what in zip(values, b.column(1).to_pylist()):
                rewrite = what == REWRITE
                for node, k in more(text, what) if more else ():
                    total.setdefault((k, node), [0, 0, 0, 0, 0])[0] += 1
                split = [(x.strip(), next(han)) for x in text.split("\n")]
                if what == BODY:
                    continue
                lines = [x for x, _ in split if x]
                ideographs = [n for x, n in split if x]
                size = [len(x) + 2 * n for x, n in zip(lines, ideographs)]  # weight(x)
                for i, x in enumerate(lines):
                    title = i + 1 < len(lines) and size[i + 1] >= 150 and (i == 0 or size[i - 1] < 100) and size[i] < 130
                    for node, k in paths(x, ideographs[i]):
                        t = total.setdefault((k, node), [0, 0, 0, 0, 0])
                        if rewrite:
                            t[4] += 1
                        else:
                            t[0] += 1
                            t[1] += size[i]
                            t[2] += closed(x)
                            t[3] += title
            if len(total) > 200_000:
                yield flush(total)
        if total:
            yield flush(total)

    def flush(total):
        keys = list(total)
        cols = list(zip(*(total[k] for k in keys)))
        out = pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([n for _, n in keys]), *[pa.array(c, pa.int64()) for c in cols]], schema=shape)
        total.clear()
        return out

    src = texts if more else texts.where(F.col("kind") != BODY)
    part = src.select("text", "kind").mapInArrow(run, "b long, node string, texts long, length long, stops long, titles long, rewrites long")
    sums = [F.sum(c).alias(c) for c in ("texts", "length", "stops", "titles", "rewrites")]
    return part.groupBy("node", F.col("b").alias("bucket")).agg(*sums)


def line_ideographs(texts: list[str]) -> Iterator[int]:
    """How many ideographs each line of each text has, counted for all at once."""
    cps = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
    return iter(np.diff(np.searchsorted(np.flatnonzero((cps >= 0x3400) & (cps < 0xA000)), np.flatnonzero(cps == 10))).tolist())


def cells(line: str) -> int:
    """Cells of a table row: pieces between one kind of separator, 0 where that isn't a row."""
    s = line.strip()
    if (n := s.count("|")) >= 2:
        return n - 1
    if "\t" in line:
        return line.count("\t") + 1
    for sep in (";", ","):
        if (n := s.count(sep)) >= 2 and f"{sep} " not in s.replace(f'"{sep} ', ""):
            return n + 1
    if "  " not in s:
        return 0
    n = len(re.findall(r"\S {2,}(?=\S)", s))
    return n + 1 if n >= 2 or (n == 1 and re.search(r"\d\s*$", s)) else 0


def data_row(line: str, n: int | None = None) -> bool:
    """A row of cells with figures or empty cells; a line of links has neither. n: its cells, where they are counted already."""
    return (cells(line) if n is None else n) >= 2 and (bool(re.search(r"\d", line)) or "||" in line or ",," in line or ";;" in line or line.rstrip(" ").endswith((",", ";", "\t"))) and "©" not in line and "·" not in line


class LineModel:
    """Verdicts per path bucket: 2 MB each, whatever the corpus."""

    def __init__(self, decoder: Decoder, furniture: np.ndarray, kept: np.ndarray):
        self.decoder = decoder
        self.furniture, self.kept = furniture, kept

    def verdict(self, line: str, row: bool | None = None, size: int | None = None) -> str:
        """'furniture' by its paths, 'kept' if rewrites hold the line's leaf or it is a row of data, or ''. A long paragraph is body, whatever its opening.

        row, size: whether it is a row of data and the weight of the line without blanks around it, where they are known already."""
        if (data_row(line) if row is None else row) or (weight(line.strip()) if size is None else size) > 170:
            return "kept" if len(line) < 170 else ""
        at = paths(line)
        if on(self.kept, at[0][1]):
            return "kept"
        if MARKER.match(line):
            return ""  # an item is furniture only by the lines over it
        if any(on(self.furniture, k) for _, k in at):
            return "furniture"
        if not SEPARATOR.search(line):
            return ""
        parts = [p for p in SPLIT.split(DIGITS.sub("0", line.strip())) if p and p.strip('"')]
        if len(parts) >= 2 and all(on(self.furniture, bucket("leaf", p.strip('" '))) for p in parts):
            return "furniture"
        return ""

    def furniture_lines(self, text: str, fixed: str | None = None) -> list[int]:
        """Numbers (from 1) of the lines of page furniture."""
        lines = [x.strip() for x in (fixed if fixed is not None else self.decoder.text(text)).split("\n")]
        at = [i for i, x in enumerate(lines) if x]
        size = {i: weight(lines[i]) for i in at}
        mark = {i: self.verdict(lines[i]) for i in at}
        body = {i: mark[i] != "furniture" and (size[i] >= 110 or (closed(lines[i]) and size[i] >= 45)) for i in at}
        if not any(mark[i] == "furniture" for i in at):
            return []
        out = [i for i in at if mark[i] == "furniture"]
        inside = set(out)
        run: list[int] = []
        first_body = next((i for i in at if body[i]), None)
        for k, i in enumerate(at + [-1]):
            if i >= 0 and not body[i]:
                run.append(i)
                continue
            # `run` holds the short lines between two paragraphs; i is the paragraph after them, -1 the end
            head = i >= 0 and i == first_body
            after_furniture = False
            for j, r in enumerate(run):
                if r in inside:
                    after_furniture = True
                    continue
                nxt = run[j + 1] if j + 1 < len(run) else None
                last_before_body = nxt is None and i >= 0
                if mark[r] == "kept":
                    continue
                if head:
                    # the title stands directly over the body; before it, what follows furniture is an entry
                    if after_furniture and not last_before_body and self._entry(lines[r]):
                        inside.add(r)
                    continue
                if after_furniture and self._entry(lines[r]):
                    inside.add(r)
            run = []
        return [i + 1 for i in sorted(inside)]

    @staticmethod
    def _entry(line: str) -> bool:
        return not closed(line) and weight(line) < 130


def line_model(texts: DataFrame, decoder: Decoder) -> LineModel:
    """The path statistics of the whole corpus, and from them one verdict per bucket."""
    return of_statistics(path_statistics(texts), decoder)


def of_statistics(s: DataFrame, decoder: Decoder) -> LineModel:
    s = s.where(F.col("node").isin("leaf", "open", "close"))
    n = F.col("texts")
    share = n / (n + F.col("rewrites"))
    content = F.col("length") / n / MOST_LENGTH + STOP_WEIGHT * F.col("stops") / n
    furniture = (n >= LEAST_TEXTS) & (share >= LEAST_SHARE) & (content <= 1.0) & (F.col("titles") / n <= MOST_TITLE)
    kept = (F.col("node") == "leaf") & (F.col("rewrites") >= 3) & (share < 0.75)
    out = bitmaps(s.where(furniture | kept), "bucket", {"furniture": furniture, "kept": kept})
    return LineModel(decoder, out["furniture"], out["kept"])


def furniture(records: DataFrame, texts: DataFrame, model: LineModel) -> DataFrame:
    """(uid, line_no) of every line of page furniture in the source texts, lists, tables and junk not yet left out.

    Null and empty texts have no row; a record delivered twice has each row once. Every distinct text is read once."""

    def run(it):
        for b in batches(it, ["text"], 4 << 20):
            h, g, no = [], [], []
            for x, y, t, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), ts := b.column(2).to_pylist(), model.decoder.texts(ts)):
                found = model.furniture_lines(t, f)
                h += [x] * len(found)
                g += [y] * len(found)
                no += found
            if no:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (h, g, no)], names=[*KEY, "line_no"])

    found = texts.where(F.col("kind") == SOURCE).select(*KEY, "text").mapInArrow(run, "h long, g long, line_no long")
    return corpus.keyed(records, "uid", kinds=(SOURCE,)).dropDuplicates(["uid"]).join(found, KEY).select("uid", "line_no")


def main_text(records: DataFrame, lines: DataFrame) -> DataFrame:
    """(uid, main_text, dropped_lines): the source text without the given furniture lines, and their numbers. One row per uid with a text."""
    drop = lines.groupBy("uid").agg(F.sort_array(F.collect_list("line_no")).alias("dropped_lines"))
    src = records.where("_source_text is not null").groupBy("uid").agg(F.min("_source_text").alias("_t")).join(drop, "uid", "left")
    src = src.withColumn("dropped_lines", F.coalesce("dropped_lines", F.array().cast("array<bigint>")))
    kept = F.filter(F.split("_t", "\n", -1), lambda x, i: ~F.array_contains("dropped_lines", (i + 1).cast("long")))
    return src.select("uid", F.array_join(kept, "\n").alias("main_text"), "dropped_lines")
