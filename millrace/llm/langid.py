"""Problem 1: a language with a confidence for every text and every line of another language.

Method: nearest-centroid classification. A line is a TF-IDF vector of hashed character 1- to 3-grams,
scaled to length 1; every language has several centroids, found by spherical k-means over a bounded
sample of labelled rows; the nearest centroid by cosine names the language. A line whose cosine is low
for its length is rejected (no readable language), and so is a text whose lines are. Labels that the
centroids contradict leave the sample, and the centroids are fitted again. Wrongly decoded lines are
restored first (problem 3), so they count with the language they had.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import corpus
from .arrowtext import batches
from .codepages import Decoder, fit
from .corpus import KEY, SOURCE

LANGUAGES = ["en", "zh", "de", "fr", "es", "pt", "ru"]
# Spellings of the languages in labels (ISO 639-1, 639-2, 639-3 and names).
SPELLINGS = {
    "en": "en eng english englisch anglais inglés ingles inglês английский 英语 英文",
    "zh": "zh zho chi cmn chinese chinesisch chinois chino chinês китайский mandarin 中文 汉语 华语 cn",
    "de": "de deu ger german deutsch allemand alemán aleman alemão немецкий 德语",
    "fr": "fr fra fre french français francais französisch francés frances francês французский 法语",
    "es": "es spa spanish español espanol castellano spanisch espagnol espanhol испанский 西班牙语",
    "pt": "pt por portuguese português portugues portugiesisch portugais portugués португальский 葡萄牙语",
    "ru": "ru rus russian русский russisch russe ruso russo 俄语",
}
_CODE = {w: k for k, v in SPELLINGS.items() for w in v.split()}
#: Labelled texts of each language, at most, that the centroids are fitted on: those of the least digests.
SAMPLE_TEXTS = 700
DIMS = 4096
CENTROIDS = 3
#: Least cosine of a readable line, at 20 characters or less and at 200 or more; between them by the logarithm of the length.
NEAR = (0.10, 0.22)
#: Least mean log-probability of the character pairs of a readable line.
SENSE = -4.6
#: A line of another language must lead the main one by this share of its cosine.
LEAD = 0.12


_HAN, _CYRILLIC, _LATIN = re.compile("[㐀-鿿]"), re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-zÀ-ɏ]")
_CODES = re.compile(r"\b(?=\w*\d)(?=\w*[A-Za-z])\w{3,}\b")
_CELLS = re.compile(r"[|·>\t;/]|  |,\S")


def code_of(label: str | None) -> str | None:
    """The language a label names, or None: 'EN', 'en-US', 'eng', 'English', 'zh_Hans' ... Null, blank, placeholders and other languages give None."""
    if not label:
        return None
    w = label.strip().lower()
    return _CODE.get(w) or _CODE.get(w.replace("_", "-").split("-")[0].strip()) or _CODE.get(w.split("(")[0].split()[0] if w.split("(")[0].split() else "")


@lru_cache(1)
def letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x20000)], np.bool_)


def label_code(label: Column) -> Column:
    """code_of as a column: null for null, blank and placeholder labels and for other languages."""
    w = F.lower(F.trim(label))
    table = F.create_map(*[F.lit(x) for kv in _CODE.items() for x in kv])
    return F.coalesce(F.try_element_at(table, w), F.try_element_at(table, F.trim(F.substring_index(F.translate(w, "_", "-"), "-", 1))), F.try_element_at(table, F.regexp_extract(w, r"^([^\s(]+)", 1)))


def grams(lines: list[str]) -> np.ndarray:
    """lines x DIMS: counts of the hashed 1- to 3-grams of the letters of each line, case folded; a run of other signs is one blank."""
    n = len(lines)
    cps = np.frombuffer("\n".join([x.replace("\n", " ") for x in lines]).lower().encode("utf-32-le"), np.uint32)
    if not len(cps):
        return np.zeros((n, DIMS), np.float32)
    nl = cps == 10
    row = np.cumsum(nl) - nl
    cps = np.where(letters()[np.minimum(cps, 0x1FFFF)] | nl, cps, np.uint32(32))
    keep = np.concatenate([[True], ~((cps[1:] == 32) & ((cps[:-1] == 32) | nl[:-1]))])
    cps, row, nl = cps[keep], row[keep], nl[keep]
    h1 = cps * np.uint32(0x9E3779B1)
    h2 = (h1[:-1] ^ (cps[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    h3 = (h2[:-1] ^ (cps[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    ok2 = ~(nl[:-1] | nl[1:])
    ok3 = ok2[:-1] & ~nl[2:]
    one = ~nl & (cps != 32)
    at = [(row[one], h1[one]), (row[:-1][ok2], h2[ok2]), (row[:-2][ok3], h3[ok3])]
    out = np.zeros(n * DIMS, np.float32)
    for r, h in at:
        out += np.bincount(r * DIMS + (h >> np.uint32(32 - 12)).astype(np.int64), minlength=n * DIMS)
    return out.reshape(n, DIMS)


class Centroids:
    """idf, the centroids and their languages: under 1 MB whatever the corpus."""

    def __init__(self, idf: np.ndarray, centres: np.ndarray, owner: np.ndarray):
        self.idf, self.owner = idf, owner
        self.at = np.ascontiguousarray((centres * idf).T.astype(np.float32))
        self.centres = centres

    def cosines(self, lines: list[str], block: int = 256) -> np.ndarray:
        """lines x languages: the cosine with the nearest centroid of each language."""
        out = np.zeros((len(lines), len(LANGUAGES)), np.float32)
        for i in range(0, len(lines), block):
            g = grams(lines[i : i + block])
            w = g * self.idf
            norm = np.sqrt(np.einsum("ij,ij->i", w, w)) + 1e-9
            c = (g @ self.at) / norm[:, None]
            for k in range(len(LANGUAGES)):
                mine = self.owner == k
                if mine.any():
                    out[i : i + block, k] = c[:, mine].max(axis=1)
        return out


def _kmeans(x: np.ndarray, k: int, rng) -> np.ndarray:
    """Spherical k-means; fewer centroids where there are fewer points."""
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(8):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(k)])
        c /= np.linalg.norm(c, axis=1, keepdims=True) + 1e-9
    return c


def fit_centroids(texts: list[tuple[str | None, str | None]], decoder: Decoder, per_language: int = 500, seed: int = 0) -> Centroids:
    """texts: (label, text) of a bounded sample. Of each language `per_language` long and as many short lines are used at most."""
    rng = np.random.default_rng(seed)
    by: dict[str, dict[str, None]] = {k: {} for k in LANGUAGES}
    for label, text in {(a, b): None for a, b in texts}:
        lang = code_of(label)
        if lang and text:
            for s in text.split("\n"):
                if len(s) >= (4 if lang == "zh" else 12):
                    by[lang][decoder.line(s)[0]] = None
    lines, owner = [], []
    for k, lang in enumerate(LANGUAGES):
        own = list(by[lang])
        for part in ([s for s in own if len(s) >= 60], [s for s in own if len(s) < 60]):
            pick = [part[i] for i in sorted(rng.permutation(len(part))[:per_language])]
            lines += pick
            owner += [k] * len(pick)
    if not lines:
        return Centroids(np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, np.int64))
    g = np.concatenate([grams(lines[i : i + 256]) for i in range(0, len(lines), 256)])
    idf = (np.log((1 + len(lines)) / (1 + (g > 0).sum(axis=0))) + 0.2).astype(np.float32)
    x = g * idf
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    owner = np.array(owner)
    keep = np.ones(len(lines), np.bool_)
    for _ in range(3):
        centres, own = [], []
        for k in range(len(LANGUAGES)):
            mine = x[keep & (owner == k)]
            if len(mine):
                c = _kmeans(mine, CENTROIDS, rng)
                centres.append(c)
                own += [k] * len(c)
        centres, own = np.concatenate(centres), np.array(own)
        # a wrong label makes a cluster beside its language: a line must be nearer to the mean of its language than to any other's
        means = np.stack([(m := x[keep & (owner == k)].mean(axis=0) if (keep & (owner == k)).any() else np.zeros(DIMS)) / (np.linalg.norm(m) + 1e-9) for k in range(len(LANGUAGES))])
        keep = (x @ means.T).argmax(axis=1) == owner
    return Centroids(idf, centres.astype(np.float32), own)


def readable_share(s: str) -> float:
    """Distinct words (ideographs) of a line over all: near 0 where one scrap is repeated."""
    w = s.split()
    if len(w) < 8:
        w = list(s.replace(" ", ""))
        return 1.0 if len(w) < 24 else min(1.0, len(set(w)) / 12)
    return len(set(w)) / len(w) * (1.0 if len(w) < 30 else 2.0)


class Identifier:
    def __init__(self, decoder: Decoder, centroids: Centroids):
        self.decoder, self.centroids = decoder, centroids

    @staticmethod
    def _by_script(lines: list[str], cos: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Only the centroids of languages that write a line's script compete for it; where that is one language, half the least cosine will do."""
        zh, ru = LANGUAGES.index("zh"), LANGUAGES.index("ru")
        cos, least = cos.copy(), least.copy()
        for j, s in enumerate(lines):
            if s.isascii():
                script = "latin"
            else:
                han, cyr, lat = 2 * len(_HAN.findall(s)), len(_CYRILLIC.findall(s)), len(_LATIN.findall(s))
                script = "han" if han >= max(cyr, lat, 1) else "cyrillic" if cyr >= max(lat, 1) else "latin"
            if script == "latin":
                cos[j, [zh, ru]] *= 0.2
            else:
                own = zh if script == "han" else ru
                keep = cos[j, own]
                cos[j] *= 0.2
                cos[j, own] = keep
                least[j] /= 2
        return cos, least

    def _figures(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per line: letters (an ideograph counts for three), characters but blanks, mean log-probability of its character pairs."""
        if not lines:
            return (np.zeros(0),) * 3
        cps = np.frombuffer("\n".join([x.replace("\n", " ") for x in lines]).encode("utf-32-le"), np.uint32)
        nl = cps == 10
        row = np.cumsum(nl) - nl
        n = len(lines)
        count = lambda mask: np.bincount(row[mask], minlength=n).astype(np.float64)
        pairs, _ = self.decoder.lm.scores(cps)
        inner = ~(nl[:-1] | nl[1:])
        mean = np.bincount(row[:-1][inner], pairs[inner], n) / np.maximum(count(np.concatenate([inner, [False]])), 1)
        han = (cps >= 0x3400) & (cps < 0xA000)  # an ideograph stands for about three letters
        return count(letters()[np.minimum(cps, 0x1FFFF)]) + 2 * count(han), count((cps > 32) & (cps != 0x3000)), mean

    def texts(self, texts: list[str]) -> list[list[tuple[int, str, float]]]:
        """Per text: (0, main language, confidence) and (line number, language, confidence) of each line of another language; [] without a readable language.

        The confidence is the lead of the best language over the second, as a share of its cosine, for the text the mean over its lines."""
        lines, owner, number = [], [], []
        for i, fixed in enumerate(self.decoder.texts(texts)):
            for n, s in enumerate(fixed.split("\n"), 1):
                s = s.strip()
                if s:
                    lines.append(s)
                    owner.append(i)
                    number.append(n)
        cos = self.centroids.cosines(lines)
        out: list[list] = [[] for _ in texts]
        per: list[list[int]] = [[] for _ in texts]
        for j, i in enumerate(owner):
            per[i].append(j)
        size = np.array([len(s) for s in lines], np.float64)
        least = NEAR[0] + (NEAR[1] - NEAR[0]) * np.clip(np.log(np.maximum(size, 1) / 20) / np.log(10), 0, 1)
        cos, least = self._by_script(lines, cos, least)
        best = cos.argmax(axis=1) if len(lines) else np.zeros(0, np.int64)
        top = cos.max(axis=1) if len(lines) else np.zeros(0)
        second = np.partition(cos, -2, axis=1)[:, -2] if len(lines) else top
        conf = (top - second) / (top + 1e-9)
        n_letters, shown, sense = self._figures(lines)
        good = (top >= least) & (n_letters >= 0.35 * shown) & (sense > SENSE)
        good &= np.array([readable_share(s) > 0.3 and 3 * len(_CODES.findall(s)) < len(s.split()) for s in lines], np.bool_)
        for i, js in enumerate(per):
            ok = [j for j in js if good[j]]
            if not ok or 4 * len(ok) < len(js):
                continue
            votes, chars = Counter(), Counter()
            for j in ok:
                votes[best[j]] += 1
                chars[best[j]] += float(size[j] * conf[j])
            main = max(votes, key=lambda k: (votes[k] + 2 * chars[k] / sum(chars.values()) if sum(chars.values()) else votes[k], -k))
            out[i].append((0, LANGUAGES[main], float(np.mean([conf[j] for j in ok if best[j] == main]))))
            for j in ok:
                if best[j] == main:
                    continue
                lead = (cos[j, best[j]] - cos[j, main]) / (cos[j, best[j]] + 1e-9)
                # a line in its own right: a closed sentence, or long enough to be one
                if "©" in lines[j]:
                    continue  # names and years, in no language of their own
                whole = lines[j].rstrip("\"'”»“）)」』").endswith((".", "!", "?", "。", "！", "？", "…"))
                if lead >= LEAD and n_letters[j] >= 12 and (whole or (n_letters[j] >= 40 and not _CELLS.search(lines[j]))):
                    out[i].append((number[j], LANGUAGES[best[j]], float(lead)))
        return out


def identifier(records: DataFrame, texts: DataFrame, label: str = "lang", rows: int = SAMPLE_TEXTS) -> Identifier:
    """The decoder is fitted on all texts, the centroids on a sample of labelled source texts (`rows` a language)."""
    decoder = fit(texts)
    return Identifier(decoder, fit_centroids(corpus.labelled_sample(records, texts, label_code(F.col(label)), rows), decoder))


def languages(records: DataFrame, texts: DataFrame, ident: Identifier, label: str = "lang") -> DataFrame:
    """(uid, label, seg_no, lang, confidence): segment 0 is the source text, segment n its line n where that is in another language.

    Null, empty and unreadable texts have no row. A record delivered twice has each row once. Every distinct text is read once."""

    def run(it):
        for b in batches(it, ["text"], 1 << 20):
            h, g = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = [(h[i], g[i], n, k, c) for i, found in enumerate(ident.texts(b.column(2).to_pylist())) for n, k, c in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()))], names=[*KEY, "seg_no", "lang", "confidence"])

    found = texts.where(F.col("kind") == SOURCE).select(*KEY, "text").mapInArrow(run, "h long, g long, seg_no long, lang string, confidence double")
    keys = corpus.keyed(records, "uid", F.col(label).alias("label"), kinds=(SOURCE,)).dropDuplicates(["uid"])
    return keys.join(found, KEY).select("uid", "label", "seg_no", "lang", "confidence")
