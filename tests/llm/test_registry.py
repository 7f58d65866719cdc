import os
import subprocess
import sys

import corpus_pipeline
from wardlake.llm.packing import packed
from wardlake.llm.queries import ORACLES, QUERIES
from wardlake.llm.shared import in_workers

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_chain_and_empty_tables_pass_through(spark, docs, no_docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "mix_sources", "packing",
    ]
    now, empty = docs, no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "").persist()
        empty = stage(spark, empty, "")
        assert now.columns == docs.columns and now.count() > 0
        assert empty.columns == docs.columns and empty.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert last.columns == packed(docs, with_ids=True).columns
    assert {r[0] for r in last.select("doc_id").collect()} <= {
        r[0] for r in docs.select("doc_id").collect()
    }


def test_native_operators_run_no_python(spark, docs):
    from wardlake.llm.exact_dedup import exact_duplicates
    from wardlake.llm.kd_shards import kd_shards
    from wardlake.llm.mixing import mix

    for operator in (exact_duplicates, kd_shards, mix):
        plan = operator(docs)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_workers_find_the_package(spark):
    in_workers(spark.range(1))
    assert ROOT in spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)


def test_entry_works_without_the_corpus_files(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('wardlake.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and 'pipeline' not in e.queries()\n"
        "assert not any(k.startswith('op') and k[2].isdigit() for k in e.queries())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()
