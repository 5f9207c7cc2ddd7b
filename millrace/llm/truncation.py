"""Problem 2: values that were cut at a field limit or in transfer, and how often each source cuts.

Method: per source and field the lengths of the distinct values (in characters and in bytes) are fitted by a
log-normal whose values at candidate limits may be right-censored; limits and parameters are found in turns by
maximum likelihood on the length counts. A length that far more values share than the curve allows is a limit,
and the surplus share is the posterior that a value of that length was censored. It is the prior of the value, and
added to the evidence of its ending: marks of omission, open sentences, items and rows that the corpus does not
know as whole, against line ends (credits, footers, keywords) that recur in the corpus. What each ending tells is learnt from the
data by EM, as endings at limits and elsewhere differ; values that end with a full stop are no cases by definition.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import corpus
from ..cluster import cut
from .arrowtext import batches
from .codepages import LOST
from .corpus import BODY, KEY, SOURCE
from .langid import Identifier
from .pages import HAN, MARKER, LineModel, cells, closed, data_row, of_statistics, path_statistics, weight
from .pairs import LABEL, LEAST, MARK, SHARE, PairModel, is_copy, is_nothing, key64, open_shapes, split_pairs, stem_and_options, usual, written
from .quality import DIGIT, MIXED, Figures

#: What an ending counts as: inside a sentence or row; a short line or item that the corpus doesn't know; a whole item or row; a line end that recurs.
ENDS_AS = {"mark": "unfinished", "open": "unfinished", "row_cut": "unfinished", "item_unknown": "unknown", "short_unknown": "unknown", "item": "item", "row": "item", "known": "known"}
#: Where the learning of their ratios starts: log-likelihood ratios of cut against whole values, how many values that guess counts for, and the share of cuts in transfer.
START = {"unfinished": 4.0, "unknown": 2.0, "item": -2.0, "known": -2.0}
START_VALUES, START_SHARE = 4.0, 0.25
#: By definition no cases: values that end with a full stop, and junk.
WHOLE = ("closed", "junk")
NEVER = -12.0
#: Surplus that makes a length a limit: this many values at least, and so many times what the curve expects.
LIMIT_VALUES, LIMIT_TIMES = 5, 6.0
#: The posterior of a limit counts up to here, so that a strong limit outweighs a known ending and a weak one doesn't.
MOST_POSTERIOR = 0.999
LABELLED = re.compile(r"^([^\s:：]{2,14}(?: [^\s:：]{1,10})? ?[:：])")


def last_line(value: str) -> tuple[str, list[str]]:
    """(the last line that isn't blank, the ones before it)."""
    lines = [x for x in value.split("\n") if x.strip()]
    return (lines[-1].strip(" \r\u3000"), lines[:-1]) if lines else ("", [])


def line_keys(line: str) -> list[int]:
    """Keys that a recurring line end shares: the line with figures and names masked, its label, for Chinese its opening and closing."""
    s = re.sub(r"\d+(?:[.,]\d+)*", "0", MARKER.sub("", line.strip(), count=1))
    out = []
    if HAN.search(s):
        if weight(s) < 90:
            out.append(key64("h" + s[:4] if len(s) > 6 else "w" + s))
            out.append(key64("t" + s[-5:]))
    else:
        w = s.split()
        if len(w) <= 14:
            out.append(key64("m" + " ".join("X" if x[:1].isupper() or x[:1] in "“«\"„" else x for x in w)))
    m = LABELLED.match(s)
    if m and weight(s) < 110:
        out.append(key64("l" + m.group(1)))
    return out


def item_key(line: str) -> int:
    """The item without its marker, names and figures masked."""
    s = re.sub(r"\d+(?:[.,]\d+)*", "0", MARKER.sub("", line.strip(), count=1))
    if HAN.search(s):
        return key64("i" + (s if len(s) > 2 else "~") if "：" not in s and ":" not in s and "，" not in s else "i" + re.split("[:：，]", s, maxsplit=1)[1])
    w = s.split()
    return key64("i" + " ".join([*w[:1], *("X" if x[:1].isupper() else x for x in w[1:])] if ":" not in s and "," not in s else ["X"] + re.split("[:,]", s, maxsplit=1)[1].split()))


def short_open(line: str) -> bool:
    return weight(line) < 110 and not closed(line)


def ending_keys(text: str) -> list[tuple[str, int]]:
    """('end', key) of an unclosed last line, ('item', key) of the unclosed short lines before it, where nothing is cut."""
    last, before = last_line(text)
    out = [("end", k) for k in line_keys(last)] if last and not closed(last) and not MARK.search(last) else []
    return out + [("item", item_key(x)) for x in {x.strip() for x in before if short_open(x.strip())}]


def keys_of(text: str, kind: int) -> list[tuple[str, int]]:
    return [("shape", k) for k in open_shapes(text)] if kind == BODY else ending_keys(text)


def models(texts: DataFrame, decoder) -> tuple[frozenset[int], frozenset[int], DataFrame, LineModel]:
    """(line ends, answer shapes, items, line model) from one pass: keys of the unclosed last lines and of the shapes of unclosed answers that recur in
    the corpus (bounded by their share of all), keys of all the short lines that stand before a last line, and the furniture verdicts."""
    s = cut(path_statistics(texts, keys_of))
    of = lambda node: s.where(F.col("node") == node).select(F.col("bucket").alias("key"), F.col("texts").alias("n"))
    return usual(of("end"), 4, 3e-4), usual(of("shape"), LEAST, SHARE), of("item").select("key"), of_statistics(s, decoder)


class Endings:
    """Names the kind of a value's ending; travels with a task."""

    def __init__(self, ends: frozenset[int], lines: LineModel, pair_model: PairModel):
        self.ends, self.lines, self.pairs = ends, lines, pair_model

    @property
    def decoder(self):
        return self.pairs.identifier.decoder

    def of_text(self, value: str, fixed: str | None = None) -> tuple[str, int | None]:
        """(kind of ending, None) of a text, or ('listed', the key of the item) where the corpus must tell whether it knows the item as whole.

        `fixed` is the text with its wrongly decoded lines restored."""
        last = value.rstrip().rpartition("\n")[2]
        if not last or (closed(last) and not MARK.search(last)):
            return "closed", None
        text = self.decoder.text(value) if fixed is None else fixed
        last, before = last_line(text)
        if not last or last.endswith(LOST):
            return "closed", None  # the last character is lost, so there is no telling
        marked = bool(MARK.search(last))
        if not marked and closed(last):
            return "closed", None
        if self._junk(text, last):
            return "junk", None
        if marked:
            return "mark" if MARK.sub("", last).strip() or before else "closed", None
        n = cells(last)
        rows = []  # the rows of cells directly over the last line
        for x in reversed(before):
            if cells(x) < 2:
                break
            rows.append(cells(x))
        if n >= 2 and (data_row(last) or len(rows) >= 2):
            return "row_cut" if rows and n < min(rows) and "  " not in last else "row", None
        if Figures._enumeration(last):
            return "item", None
        listed = bool(MARKER.match(last)) or (before and short_open(before[-1].strip()) and weight(last) < 110)
        if self.lines.verdict(last) == "furniture" or any(k in self.ends for k in line_keys(last)):
            return "known", None
        if before and cells(before[-1]) >= 3 and data_row(before[-1]):
            return "row_cut", None
        if weight(last) >= 110 or re.search(r"[.!?]\s+\S|[。！？]", MARKER.sub("", last)):
            return "open", None
        if listed:
            return "listed", item_key(last)
        if not before and weight(last) < 60:
            return "known", None  # a short value of one line, such as a title or a notice
        return "open" if weight(last) >= 60 else "short_unknown", None

    def of_pairs(self, body: str, fixed: str | None = None) -> str:
        """The same of what stands behind the source text of a qa record: the ending of its last answer."""
        body = self.decoder.text(body) if fixed is None else fixed
        at = [m.start() for m in LABEL.finditer(body)]
        pairs = split_pairs(body[at[-1] :] if at else body, None)
        if not pairs:
            return "closed"
        q, a = pairs[-1]
        if is_nothing(a) or self.pairs.is_refusal(a) or is_copy(stem_and_options(q)[0], a):
            return "closed"
        if not self.pairs.is_truncated(q, a):
            return "closed" if closed(a) else "known"
        return "mark" if MARK.search(a) else "open"

    def _junk(self, value: str, last: str) -> bool:
        if Figures._variety(value) < 0.2:
            return True
        tail = value
        letters = sum(map(str.isalpha, tail))
        if sum(map(str.isalnum, tail)) * 20 < 9 * len("".join(tail.split())) and "  " not in last and "||" not in last:
            return True
        if letters * 2 < len(tail.replace(" ", "")) and not HAN.search(tail) and not data_row(last) and not MARKER.match(last):
            return True
        words = len(tail.split())
        if 3 * len(DIGIT.findall(tail)) >= words and 3 * len(MIXED.findall(tail)) >= words and not data_row(last) and len(tail) > 60:
            return True
        cps = np.frombuffer(tail.encode("utf-32-le"), np.uint32)
        return len(cps) > 30 and not data_row(last) and float(self.decoder.lm.scores(cps)[0].mean()) < -4.8


def measured(records: DataFrame, texts: DataFrame, endings: Endings, items: DataFrame) -> DataFrame:
    """(uid, source, field, chars, bytes, h, ending) of every source text and content, h a digest of the value.

    Null and empty values have no row, nor has a content that holds nothing but its source text; a record delivered twice has one per field. Every distinct
    text is read once; the items asked for meet those that the corpus knows as whole by their keys."""

    def run(it):
        for b in batches(it, ["text"], 1 << 20):
            kind, value = b.column(0).to_pylist(), b.column(3).to_pylist()
            ends: list[tuple[str, int | None]] = [("closed", None)] * len(value)
            # a value that ends with a full stop as it stands does so as restored
            asked = [i for i, v in enumerate(value) if not closed(x := v.rstrip().rpartition("\n")[2]) or MARK.search(x)]
            for i, f in zip(asked, endings.decoder.texts([value[i] for i in asked])):
                ends[i] = (endings.of_pairs(value[i], f), None) if kind[i] == BODY else endings.of_text(value[i], f)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([e for e, _ in ends], pa.string()), pa.array([k for _, k in ends], pa.int64())], names=["kind", *KEY, "ending", "item"])

    found = cut(texts.select("kind", *KEY, "text").mapInArrow(run, "kind int, h long, g long, ending string, item long"))
    asked = found.where("item is not null").join(items.select(F.col("key").alias("item"), F.lit("item").alias("_e")), "item", "left")
    found = found.where("item is null").drop("item").unionByName(asked.withColumn("ending", F.coalesce("_e", F.lit("item_unknown"))).drop("item", "_e"))
    sizes = [f(c).alias(n) for c, k in (("_source_text", "s"), ("content", "c")) for f, n in ((F.length, f"c_{k}"), (F.octet_length, f"b_{k}"), (F.xxhash64, f"h_{k}"))]
    keys = corpus.keyed(records, "uid", F.coalesce("source", F.lit("")).alias("source"), *sizes).dropDuplicates(["uid", "kind"])
    of = lambda n: F.when(F.col("kind") == SOURCE, F.col(f"{n}_s")).otherwise(F.col(f"{n}_c"))
    keys = keys.select("uid", "source", "kind", F.col("h").alias("_h"), F.col("g").alias("_g"), F.when(F.col("kind") == SOURCE, F.lit("_source_text")).otherwise(F.lit("content")).alias("field"), of("c").alias("chars"), of("b").alias("bytes"), of("h").alias("h"))
    return keys.join(found.select("kind", F.col("h").alias("_h"), F.col("g").alias("_g"), "ending"), ["kind", "_h", "_g"]).drop("kind", "_h", "_g")


def censored_fit(lengths: np.ndarray, counts: np.ndarray, rounds: int = 6) -> tuple[float, float, dict[int, float]]:
    """(mean and deviation of log length, posterior of being censored at each limit) of length counts, by turns:
    limits from the surplus over the curve, then the curve by EM with the surplus counted as right-censored."""
    x = np.log(np.maximum(lengths, 1))
    n = counts.astype(float)
    mu = float((x * n).sum() / n.sum())
    sd = float(max(np.sqrt(((x - mu) ** 2 * n).sum() / n.sum()), 0.05))
    limits: dict[int, float] = {}
    # values per length around each one, itself left out: the curve's check where the log-normal fits badly
    order = np.argsort(lengths)
    cum = np.concatenate([[0.0], np.cumsum(n[order])])
    lo, hi = (lengths * 0.95).astype(np.int64) - 3, (lengths * 1.05).astype(np.int64) + 3
    inside = cum[np.searchsorted(lengths[order], hi + 1)] - cum[np.searchsorted(lengths[order], lo)] - n
    near = inside / np.maximum(hi - lo, 1)

    for _ in range(rounds):
        pdf = np.exp(-0.5 * ((x - mu) / sd) ** 2) / (sd * math.sqrt(2 * math.pi) * np.maximum(lengths, 1))
        expect = np.maximum(n.sum() * pdf, near) + 0.2
        new = {int(v): float((c - e) / c) for v, c, e in zip(lengths, n, expect) if c >= LIMIT_VALUES and c >= LIMIT_TIMES * e}
        c = np.array([new.get(int(v), 0.0) for v in lengths])
        # E: a censored value lies beyond its limit; first two moments of the tail of the curve
        z = (x - mu) / sd
        tail = np.maximum(0.5 * np.array([math.erfc(v / math.sqrt(2)) for v in z]), 1e-9)
        hazard = np.exp(-0.5 * z**2) / math.sqrt(2 * math.pi) / tail
        m1 = mu + sd * hazard
        m2 = mu**2 + 2 * mu * sd * hazard + sd**2 * (1 + z * hazard)
        first = (1 - c) * x + c * np.clip(m1, x, x + 3)
        second = (1 - c) * x**2 + c * np.maximum(m2, x**2)
        mu = float((n * first).sum() / n.sum())
        sd = float(np.clip(np.sqrt(max((n * second).sum() / n.sum() - mu**2, 0.0025)), 0.05, 1.5))
        if new.keys() == limits.keys():
            break
        limits = new
    return mu, sd, limits


def limits(values: DataFrame) -> DataFrame:
    """(source, field, unit, length, posterior): candidate limits per source and field, in characters or bytes.

    The lengths of distinct values are counted first, so the group that a fit sees has one row per length."""
    distinct = values.select("source", "field", "h", "chars", "bytes").dropDuplicates(["source", "field", "h"])
    long = distinct.select("source", "field", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("u")).select("source", "field", "u.*")
    hist = long.groupBy("source", "field", "unit", "length").agg(F.count("*").alias("n"))

    def fit(keys, g: pd.DataFrame) -> pd.DataFrame:
        _, _, lim = censored_fit(g["length"].to_numpy(), g["n"].to_numpy())
        return pd.DataFrame({"source": keys[0], "field": keys[1], "unit": keys[2], "length": list(lim), "posterior": list(lim.values())}, columns=["source", "field", "unit", "length", "posterior"])

    return hist.groupBy("source", "field", "unit").applyInPandas(fit, "source string, field string, unit string, length int, posterior double")


def learn_ratios(endings: list[str], p: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[dict[str, float], float]:
    """({ending: log-likelihood ratio of cut against whole}, log-odds of a cut at no limit) from counts n of unclosed values by ending and censoring posterior p (0: no limit).

    EM with the censoring posterior as each value's prior: endings at limits tell what cut values end like, those elsewhere mostly what whole ones do, and
    how often values are cut in transfer is learnt with them."""
    names = list(START)
    at = np.array([names.index(ENDS_AS[e]) for e in endings], np.int64)
    start = np.exp([START[k] for k in names])
    cut_share, whole_share = start / start.sum(), (1 / start) / (1 / start).sum()
    ratio, base = np.log(cut_share / whole_share), START_SHARE
    limit = p > 0
    for _ in range(rounds):
        prior = np.where(limit, p, base)
        odds = np.log(prior / (1 - prior)) + ratio[at]
        r = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        a = np.bincount(at, n * r, len(names)) + START_VALUES * cut_share
        b = np.bincount(at, n * (1 - r), len(names)) + START_VALUES * whole_share
        ratio = np.log(a / a.sum()) - np.log(b / b.sum())
        free = (n * ~limit).sum()
        base = float(np.clip(((n * r * ~limit).sum() + START_SHARE) / (free + 1), 1e-4, 0.9))
    return {e: float(ratio[names.index(k)]) for e, k in ENDS_AS.items()}, math.log(base / (1 - base))


def truncated(values: DataFrame) -> DataFrame:
    """values with limit_posterior and log_odds: the censoring posterior at the value's length, and the log-odds that it was cut, from that and its ending.

    The ratios of the endings are learnt from all values: they are counted by ending and posterior (in hundredths), at most a thousand rows."""
    lim = cut(limits(values))  # a few rows, used twice
    for unit in ("chars", "bytes"):
        own = lim.where(F.col("unit") == unit).select("source", "field", F.col("length").alias(unit), F.col("posterior").alias(f"p_{unit}"))
        values = values.join(own, ["source", "field", unit], "left")
    p = F.least(F.greatest(F.coalesce("p_chars", F.lit(0.0)), F.coalesce("p_bytes", F.lit(0.0))), F.lit(MOST_POSTERIOR))
    values = cut(values.select("uid", "source", "field", "chars", "bytes", "ending", p.alias("limit_posterior")))
    n = values.where(~F.col("ending").isin(*WHOLE)).groupBy("ending", F.round("limit_posterior", 2).alias("p")).agg(F.count("*").alias("n")).orderBy("ending", "p").collect()
    ratio, base = learn_ratios([r.ending for r in n], np.minimum(np.array([r.p for r in n], float), MOST_POSTERIOR), np.array([r.n for r in n], float))
    table = F.create_map(*[F.lit(x) for kv in ratio.items() for x in kv])
    prior = F.when(F.col("limit_posterior") > 0, F.log(F.col("limit_posterior") / (1 - F.col("limit_posterior")))).otherwise(F.lit(base))
    odds = F.when(F.col("ending").isin(*WHOLE), F.lit(NEVER)).otherwise(prior + F.try_element_at(table, F.col("ending")))
    return values.withColumn("log_odds", odds)


def cut_shares(values: DataFrame) -> DataFrame:
    """(source, texts, cut, share) of the source texts, one row a source, null and unnamed sources as ''."""
    v = values.where("field = '_source_text'")
    return v.groupBy("source").agg(F.count("*").alias("texts"), F.count_if(F.col("log_odds") > 0).alias("cut")).withColumn("share", F.col("cut") / F.col("texts"))


def endings(texts: DataFrame, identifier: Identifier) -> tuple[Endings, DataFrame]:
    """(the namer of endings, keys of the items that the corpus knows as whole)."""
    ends, shapes, items, lines = models(texts, identifier.decoder)
    return Endings(ends, lines, PairModel(identifier, shapes, written())), items
