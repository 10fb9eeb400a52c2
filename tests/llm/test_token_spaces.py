"""Long runs of white space give the pieces of the pattern, and do not end the process."""

import pytest

from tallygrove.llm import token_shards
from tallygrove.sources.scratch import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    with open(token_shards.VOCABULARY, "rb") as ranks:
        return token_shards.Tokenizer(ranks.read())


@pytest.mark.parametrize(
    "text",
    [
        " " * 20_000 + "x",
        " " * 5_000,
        "a" + " \n" * 3_000 + "b c",
        "\t" * 1_500 + " y",
        "x" + " " * 2_000 + "\x1c" * 5 + " z",
        " " * 1_001 + "!" + "\n" * 1_000,
        "q " * 3 + " " * 1_200 + "　" + "w" + " " * 999,
        " " * 1_100 + "é" + " " * 1_100,
    ],
)
def test_same_pieces(tokenizer, text):
    assert tokenizer.encode(text) == tokenizer.any_text(text)


def test_millions_of_blanks(tokenizer):
    assert len(tokenizer.encode(" " * 5_000_000 + "x")) == 5_000_000
    assert len(tokenizer.encode("\n " * 1_000_000)) == 2_000_000


def test_shards_of_such_texts(spark, tokenizer, tmp_path):
    texts = ["one two", " " * 5_000_000 + "x", None, "\n" * 3_000_000]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING").write.parquet(path)
    shards = token_shards.write_shards(
        spark.read.parquet(path), scratch_path(spark, "space-shards"), 4096, 64
    )
    n_tokens = sum(len(tokenizer.encode(t or "")) + 1 for t in texts)
    assert token_shards.read_shards(spark, shards).count() == -(-n_tokens // 4096)
