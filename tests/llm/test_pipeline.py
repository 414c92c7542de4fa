import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterlake.llm import mil, mixing
from rosterlake.llm.common import Scratch, crc_mod, table
from rosterlake.llm.queries import tokenizer_path
from tests.llm.corpus import sentence, words
from tests.llm.test_decontaminate import distance
from tests.llm.test_mixing import water
from tests.llm.test_neardup import brute
from tests.llm.test_tokens import ids_of

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with junk, copies, benchmark passages and clean documents."""
    rnd = random.Random(12)
    items = [(i, sentence(rnd, 30)) for i in range(5)]
    rows, labels = [], []
    for i in range(160):
        text = sentence(rnd, rnd.randint(40, 200))
        kind = ("clean", "clean", "clean", "junk", "leak", "copy", "clean", "clean")[i % 8]
        if kind == "junk":
            text = text.replace(" ", "### ")
        if kind == "leak":
            text += " " + items[i % 5][1] + " " + sentence(rnd, 20)
        if kind == "copy":
            text = rows[-5][1] if rnd.random() < 0.5 else rows[-5][1] + " more"
        rows.append((i, text, "aa", f"s{i % 3}", len(text)))
        labels.append((i, int(kind != "junk"), 0))
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_against_plain_stages(spark, folder):
    """Every decision is worked out again without the operators, but for the trained score."""
    docs = table(spark, folder, "documents")
    model = mil.train(docs, table(spark, folder, "labels"), crc_mod(F.col("doc_id"), 5) == 0)
    scored = {r.doc_id: r.score for r in mil.classify(docs, model).collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect() if scored[r.doc_id] >= mil.THRESHOLD]
    assert len(rows) == 140  # the junk is gone, nothing else
    components = brute(rows)
    rows = [r for r in rows if components[r[0]][1] == r[0]]
    items = [r.text.split() for r in table(spark, folder, "benchmark").collect()]

    def leaks(text):
        w = text.split()
        return any(distance(i, w[a : a + len(i)]) == 0 for i in items for a in range(len(w)))

    rows = [r for r in rows if not leaks(r[1])]
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want, plain = water(sizes), {}

    found = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    taken = {}
    for r in found:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert set(taken) <= {r[0] for r in rows} and max(taken.values()) <= mixing.MOST_COPIES
    for source, target in want.items():
        got = sum(taken.get(d, 0) * len(words(t)) for d, t, _, s in rows if s == source)
        assert got == pytest.approx(float(target), rel=0.15)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    plain = {d: len(ids_of(tokenizer, t)) for d, t, *_ in rows}
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, plain[r.doc_id])
        start += r.n_tokens
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found)


def test_stages_hand_on_whole_documents(spark, folder):
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark, "t").save(stage(spark, docs, folder))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.where(F.length("text") != F.col("n_chars")).isEmpty() and not docs.isEmpty()


def test_stages_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nothing_else_needs_the_corpus_part():
    """Without the corpus modules the entry still offers the other queries."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'rosterlake.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'dim_employees' in e.queries()\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
