import random

import pytest
import tiktoken

from millrace.llm import bpe


@pytest.fixture(scope="module")
def public():
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(bpe.vocabulary_path()), special_tokens={})


CASES = ["", None, " ", "\n\n  x", "Hello, world! don't  we'll", "日本語のテスト 中文字符", "русский текст", "aaaaaaaa" * 40, "émigré naïve", "<|endoftext|>", "👩‍🔬 x", "\t\tcode = {1: 'a'}", "x" * 3000, "½ Ⅷ ٣", "a\r\nb\x85c d"]


def test_ids_are_the_public_tokenizers(spark, public):
    rng = random.Random(1)
    texts = CASES + ["".join(rng.choice("ab é中я \n.,'1") for _ in range(rng.randrange(80))) for _ in range(150)]
    d = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id int, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in bpe.token_ids(d, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        assert got[i] == public.encode_ordinary(t or ""), t
    n = {r.doc_id: r.tokens for r in bpe.token_counts(d, ["doc_id"]).collect()}
    assert n == {i: len(v) for i, v in got.items()}
    assert all(bpe.decode(got[i]) == (t or "") for i, t in enumerate(texts))


def test_long_pieces_go_stepwise(public, monkeypatch):
    monkeypatch.setattr(bpe, "STEP_ROWS", 200)
    e = bpe.Encoder(bpe.vocabulary_path())
    for w in ["abcdefgh" * 8, "a" * 61, "zq" * 30]:
        assert list(e._solve([w.encode()])[0]) == public.encode_ordinary(w)


def test_table_starts_anew(spark, public, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    e = bpe.Encoder(bpe.vocabulary_path())
    for _ in range(3):
        words = [["one", " two", " three"], [], None, [" four", " two", " five"]]
        ids = e.encode(pa.array(words, pa.list_(pa.string()))).to_pylist()
        assert ids == [public.encode_ordinary("".join(w or [])) for w in words]
    assert bpe.token_ids(spark.createDataFrame([], "doc_id int, text string"), ["doc_id"]).count() == 0
