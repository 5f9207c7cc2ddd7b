"""Problem 8: the whole corpus in the ids of a public byte-level BPE vocabulary.

Method: the JVM splits texts into words by the vocabulary's pattern. A partition keeps a table of the
words it has met; words it meets first are cut at byte pairs that no vocabulary entry holds (no merge
can cross them) and the distinct pieces go to a DuckDB recursive query: token-position rows join the
merge table, every step contracts the minimum-rank pair of each piece, from the left, until none is
left. Ordered aggregation gives the ids of a piece; ids of words and texts are gathers in numpy.

Null and empty texts have the id list [] (defined value, in ids as in counts). Text that spells a
special token is ordinary text.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .arrowtext import batches

FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: The split pattern of the rank files as a Java pattern; (?U) makes \s the Unicode White_Space property.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a partition's table keeps; beyond it starts anew, which costs time and changes nothing.
TABLE_WORDS = 400_000
#: Rows of all steps of one recursive query at most (pieces longer than that go alone, stepwise).
STEP_ROWS = 3_000_000


@lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def merge_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left id, right id, id of the pair, byte pairs that occur in some entry). The id of an entry is its rank, so a merge's rank is its result."""
    r = ranks(path)
    left, right, to = [], [], []
    inside = np.zeros(65536, np.bool_)
    for tok, rank in r.items():
        b = np.frombuffer(tok, np.uint8).astype(np.int64)
        inside[b[:-1] * 256 + b[1:]] = True
        for i in range(1, len(tok)):
            a, c = r.get(tok[:i]), r.get(tok[i:])
            if a is not None and c is not None:
                left.append(a)
                right.append(c)
                to.append(rank)
    return np.array(left, np.int64), np.array(right, np.int64), np.array(to, np.int64), inside


# One step of the recursion: pairs with their merge, the least rank of each piece, and of the pairs of that
# rank every second one of an unbroken run, which is what contracting from the left leaves.
_RECURSION = """
WITH RECURSIVE t(step, w, pos, tok) AS (
    SELECT 0, w, pos, tok FROM piece_rows
  UNION ALL
    (WITH pairs AS (
        SELECT x.step, x.w, x.pos, x.tok, x.nxt, m.id AS id, min(m.id) OVER (PARTITION BY x.w) AS least
        FROM (SELECT step, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM t) x
        LEFT JOIN merges m ON m.a = x.tok AND m.b = x.nxt),
      runs AS (
        SELECT *, coalesce(id = least, false) AS hit, row_number() OVER (PARTITION BY w ORDER BY pos) AS i FROM pairs WHERE least IS NOT NULL),
      marked AS (
        SELECT *, i - coalesce(max(CASE WHEN NOT hit THEN i END) OVER (PARTITION BY w ORDER BY i), 0) AS nth FROM runs),
      taken AS (SELECT *, hit AND nth % 2 = 1 AS take FROM marked),
      gone AS (SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY i), false) AS drop_it FROM taken)
    SELECT step + 1, w, pos, CASE WHEN take THEN id ELSE tok END FROM gone WHERE NOT drop_it))
SELECT w, list(tok ORDER BY pos) AS ids FROM (SELECT *, max(step) OVER (PARTITION BY w) AS last FROM t) WHERE step = last GROUP BY w ORDER BY w
"""


class Encoder:
    """The word table of one partition."""

    def __init__(self, path: str):
        import duckdb

        a, b, to, self.inside = merge_table(path)
        self.single = np.array([ranks(path)[bytes([i])] for i in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.db.register("merge_arrow", pa.table({"a": a, "b": b, "id": to}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_arrow")
        self.pieces: dict[bytes, int] = {}
        self.piece_ids: list[np.ndarray] = []
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.offs = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _solve(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of distinct pieces, by the recursive query."""
        out: list[np.ndarray] = []
        i = 0
        while i < len(pieces):
            j, rows = i, 0
            while j < len(pieces) and (j == i or rows + len(pieces[j]) ** 2 // 2 < STEP_ROWS):
                rows += len(pieces[j]) ** 2 // 2 + 1
                j += 1
            part = pieces[i:j]
            if len(part[0]) ** 2 // 2 >= STEP_ROWS and j == i + 1:
                out.append(self._stepwise(part[0]))
            else:
                ln = np.array([len(p) for p in part], np.int64)
                w = np.repeat(np.arange(len(part)), ln)
                pos = np.arange(ln.sum()) - np.repeat(np.cumsum(ln) - ln, ln)
                rows = pa.table({"w": w, "pos": pos, "tok": self.single[np.frombuffer(b"".join(part), np.uint8)]})
                self.db.register("piece_rows", rows)
                ids = self.db.execute(_RECURSION).to_arrow_table()["ids"].combine_chunks()
                self.db.unregister("piece_rows")
                flat, offs = np.asarray(ids.flatten()), np.asarray(ids.offsets)
                out += [flat[a:b].astype(np.int32) for a, b in zip(offs[:-1], offs[1:])]
            i = j
        return out

    def _stepwise(self, piece: bytes) -> np.ndarray:
        """One very long piece: the same steps, one query each, so that only the present state is held."""
        state = pa.table({"step": np.zeros(len(piece), np.int64), "w": np.zeros(len(piece), np.int64), "pos": np.arange(len(piece)), "tok": self.single[np.frombuffer(piece, np.uint8)]})
        step = "WITH pairs AS" + _RECURSION.split("(WITH pairs AS", 1)[1].split("WHERE NOT drop_it)")[0] + "WHERE NOT drop_it ORDER BY pos"
        while True:
            self.db.register("t", state)
            after = self.db.execute(step).to_arrow_table().rename_columns(["step", "w", "pos", "tok"])
            if after.num_rows == 0:
                return np.asarray(state["tok"]).astype(np.int32)
            state = after

    def _learn(self, new: pa.Array) -> None:
        """Append distinct new words to the table."""
        new = new.cast(pa.large_binary())
        n = len(new)
        offs = np.frombuffer(new.buffers()[1], np.int64)[new.offset : new.offset + n + 1]
        raw = np.frombuffer(new.buffers()[2], np.uint8)[offs[0] : offs[-1]]
        offs = offs - offs[0]
        cut = np.ones(len(raw) + 1, np.bool_)
        if len(raw) > 1:
            cut[1:-1] = ~self.inside[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        cut[offs] = True
        at = np.flatnonzero(cut)
        data = raw.tobytes()
        spans = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        fresh = [p for p in dict.fromkeys(spans) if p not in self.pieces]
        if fresh:
            for p, ids in zip(fresh, self._solve(fresh)):
                self.pieces[p] = len(self.piece_ids)
                self.piece_ids.append(ids)
        which = [self.pieces[p] for p in spans]
        sizes = np.array([len(self.piece_ids[k]) for k in which], np.int64)
        flat = np.concatenate([self.piece_ids[k] for k in which]) if which else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        word_ends = ends[np.searchsorted(at, offs[1:])]
        self.offs = np.concatenate([self.offs, self.offs[-1] + word_ends])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.words = pa.concat_arrays([self.words, new.cast(pa.string())])
        if len(self.pieces) > TABLE_WORDS:
            self.pieces, self.piece_ids = {}, []

    def encode(self, words: pa.ListArray, counts: bool = False) -> pa.Array:
        """The ids (or their number) of each row of words."""
        if len(self.words) > TABLE_WORDS:
            self.clear()
        n = len(words)
        flat = words.flatten()
        lengths = np.asarray(pc.fill_null(pc.list_value_length(words), 0)).astype(np.int64)
        coded = flat.dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        if known.null_count:
            self._learn(coded.dictionary.filter(pc.is_null(known)))
            known = pc.index_in(coded.dictionary, value_set=self.words)
        at = np.asarray(known).astype(np.int64)[np.asarray(coded.indices)] if len(flat) else np.zeros(0, np.int64)
        size = self.offs[at + 1] - self.offs[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        bounds = ends[np.concatenate([[0], np.cumsum(lengths)])]
        if counts:
            return pa.array(np.diff(bounds), pa.int64())
        take = np.arange(ends[-1]) + np.repeat(self.offs[at] - ends[:-1], size)
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(self.flat[take], pa.int32()))


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("PUBLIC_TOKENIZERS", FOLDER), f"{name}.tiktoken")


def _encoded(df: DataFrame, keep: list[str], text: str, out: str, counts: bool, path: str) -> DataFrame:
    words = df.select(*keep, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PATTERN), F.lit(0)).alias("_w"))
    kind = LongType() if counts else ArrayType(IntegerType(), False)
    schema = StructType([*df.select(*keep).schema.fields, StructField(out, kind, False)])

    def run(it):
        enc = None
        for b in batches(it, ["_w"], 16 << 20):
            enc = enc or Encoder(path)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], enc.encode(b.column(b.num_columns - 1), counts)], names=[*keep, out])

    return words.mapInArrow(run, schema)


def token_ids(df: DataFrame, keep: list[str], text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """keep columns of every row and `out`, the ids of `text`."""
    return _encoded(df, keep, text, out, False, path or vocabulary_path())


def token_counts(df: DataFrame, keep: list[str], text: str = "text", out: str = "tokens", path: str | None = None) -> DataFrame:
    """keep columns of every row and `out`, the number of ids of `text` (0 for null)."""
    return _encoded(df, keep, text, out, True, path or vocabulary_path())


def decode(ids, path: str | None = None) -> str:
    """The text of a list of ids; the inverse of the encoding."""
    return b"".join(_by_rank(path or vocabulary_path())[i] for i in ids).decode("utf-8", errors="replace")


@lru_cache(2)
def _by_rank(path: str) -> dict[int, bytes]:
    return {v: k for k, v in ranks(path).items()}
