"""Workers need no copy of the package: everything that runs there is pickled by value."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import vitrine as v
from vitrine.llm import (hard_negatives, html_cut, jaccard_join, kneser_ney, personal_data, phrases, sentence_pieces, suffix_dedup,
                         token_counts)
from vitrine.llm.queries import model_file
text = "one two three four five six seven eight nine ten mail a@b.cd "
docs = spark.createDataFrame([(i, text * (i % 3 + 1), "en") for i in range(12)], "doc_id long, text string, lang string")
pages = spark.createDataFrame([(1, "u", "<h1>a</h1><p>" + text * 9 + "<a href=x>b</a>")], "page_id long, url string, html string")
vectors = spark.createDataFrame([(i, i % 3, [0.1 * i, 0.5]) for i in range(120)], "vec_id long, label int, embedding array<float>")
for df in (suffix_dedup.suffix_dedup_digest(docs), html_cut.extract(pages), sentence_pieces.encode(docs, model_file()),
           token_counts.count_tokens(docs, model_file(), 9), jaccard_join.near_copies(docs), kneser_ney.held_out_scores(docs),
           personal_data.personal_data_digest(docs), hard_negatives.hard_negatives(vectors), phrases.collocations(docs, 3),
           v.extract_products(pages, v.STRUCTURED, "M"), v.extract_links(pages)):
    assert df.collect()
def packages(rows):
    import importlib.util
    yield importlib.util.find_spec("vitrine") is None
assert all(spark.sparkContext.parallelize([1, 2], 2).mapPartitions(packages).collect())
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    env = {k: x for k, x in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(root=ROOT, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "all ran" in done.stdout, done.stderr[-3000:]
