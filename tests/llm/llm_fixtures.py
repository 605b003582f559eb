import random

import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.01"


def sentence(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that operators must bear: null, empty, blank, without letters, copies, near copies, long, odd signs."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    words = base.split()
    near = " ".join([*words[:30], "changed", *words[31:]])
    return [None, "", " \n\t ", "1234 !!", "a", base, base, base.upper(), near, sentence(rng, 20_000), "x" * 30_000,
            "naïve Ωmega 中文 😀\x00 ½", "<|endoftext|> it's", "mail a@b.co, ip 10.0.0.1, +1 (202) 555-0100, 4111 1111 1111 1111"]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts with null languages, a repeated row and extra columns whose names operators use themselves."""
    rows = [Row(doc_id=i, text=t, lang="en" if i % 2 else None, source=None, n_chars=None, score="mine", predicted=True,
                lang_pred=i, cell="x", base_spans=1, n=2.5, block=None) for i, t in enumerate(odd_texts)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score string, predicted boolean, "
              "lang_pred int, cell string, base_spans int, n double, block string")
    return spark.createDataFrame([*rows, rows[5]], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id < 0")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
