"""The pipeline against plain versions of its stages, and its place beside the rest."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

from plain import best_fit, contamination, jaccard_components
from tokenizers import Tokenizer

import corpus_pipeline
from adtally.llm import quality
from adtally.llm.queries import word_tokenizer

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_run_equals_plain_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.graded(documents, labels).collect() if r.predicted}
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect() if r.doc_id in good]
    pages, counts = Counter(s for _, _, s in docs), Counter()
    for _, text, source in docs:
        counts.update({(source, x) for x in text.split("\n") if x})
    gone = {k for k, n in counts.items() if n >= 3 and n > 0.1 * pages[k[0]]}
    docs = [(i, "\n".join(x for x in text.split("\n") if (s, x) not in gone)) for i, text, s in docs]
    classes = jaccard_components(docs)
    docs = [(i, t) for i, t in docs if classes[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r[0] for r in contamination(docs, items) if r[5]}
    docs = [(i, t) for i, t in docs if i not in leaks]
    rows = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(word_tokenizer())
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs}
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert dict(got) == lengths and 0 < len(docs) < documents.count()
    bins = Counter()
    for r in rows:
        bins[r.sequence_id] += r.length
    assert sorted(4096 - n for n in bins.values()) == best_fit([r.length for r in rows], 4096)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("adtally/**/*.py"), *ROOT.glob("testbed/*.py"), *ROOT.glob("tests/*.py"), *ROOT.glob("*.py")]:
        if "llm" in path.relative_to(ROOT).parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        assert "llm" not in path.read_text(), path


def test_the_rest_imports_without_it():
    code = (
        "import sys\nclass No:\n    def find_spec(self, name, *a):\n        if name.startswith('adtally.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\n"
        "assert len(e.queries()) > 80 and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
