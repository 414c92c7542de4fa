import zlib

import numpy as np
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from rosterlake.llm import tokens
from rosterlake.llm.common import Scratch
from rosterlake.llm.queries import tokenizer_path
from tests.llm.corpus import SCHEMA, awkward, documents


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]


def test_round_trip(spark, plain):
    rows = awkward()
    found = tokens.round_trip(documents(spark, rows), Scratch(spark, "t"), tokenizer_path()).orderBy("start").collect()
    assert len(found) == len(rows)
    ordered = [r.doc_id for r in found]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    start = 0
    texts = {d: t for d, t, *_ in rows if d is not None}
    for r in found:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id is not None:
            ids = np.asarray(ids_of(plain, texts[r.doc_id]), "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize(
    "text",
    ["a<|endoftext|>b <|STARTOFTEXT|> x", "don't'll WE'RE it's!", "é ́x İ İ ΑΣ ΣΑΣ.",
     "日本語 ß ﬁ ½  x", "\x1c a\x85b c", "!!'s ,,x.. 'S", "x" * 3000],
)
def test_word_by_word_equals_the_whole(plain, text):
    encoder = tokens.WordEncoder(tokenizer_path())
    for _ in range(2):
        ids = np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()
        assert ids == ids_of(plain, text)[:-1]


def test_files_are_sorted_and_indexed(spark, tmp_path):
    path = str(tmp_path / "orc")
    tokens.write_tokens(documents(spark, awkward()), path, tokenizer_path())
    ends = []
    for file in sorted(p for p in (tmp_path / "orc").iterdir() if p.suffix == ".orc"):
        held = [d for d in orc.ORCFile(str(file)).read(columns=["doc_id"]).column(0).to_pylist() if d is not None]
        assert held == sorted(held)
        ends += held[:1] + held[-1:]
        assert orc.ORCFile(str(file)).compression == "ZSTD"
    assert ends == sorted(ends)
    assert spark.read.orc(path).where("doc_id = 5").count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tokens.round_trip(empty, Scratch(spark, "t"), tokenizer_path()).collect() == []
