"""Each stage of the pipeline against brute force on its own input, and run() against the stages."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from cases import edited, prose
from pyspark.sql import functions as F
from test_operators import ALNUM, LOWER, brute_components, same

from girder.llm import toxicity


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, labels = [], []
    passage = prose(77, 40)
    for k in range(360):
        text = prose(5000 + k, 70 + k % 50)
        toxic = k % 6 == 0
        if toxic:
            words = text.split(" ")
            words[3], words[40] = "scum", ["idiot", "moron"][k % 2]
            text = " ".join(words)
        if k % 5 == 1:
            text = "Subscribe to our letter today\n" + text
        if k % 40 == 7:
            text = text + "\n" + " ".join(passage.split()[5:25])
        rows.append((k, text, "en", f"src{k % 13}", len(text)))
        labels.append((k, 1, int(toxic)))
    rows += [(1000 + k, edited(rows[k][1], k, 2), "en", "src0", 1) for k in range(1, 60, 4)] + [(2000, None, None, None, None), (2001, "", "en", "src1", 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def brute_mix(rows):
    """Each row as often as the inverse Poisson distribution says at its uniform number."""
    n = Counter(r[3] for r in rows)
    weight = {s: k**0.7 for s, k in n.items()}
    out = []
    for r in rows:
        rate = weight[r[3]] * len(rows) / (sum(weight.values()) * n[r[3]])
        u = int(hashlib.md5(f"17:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 16**13
        times, p = 0, math.exp(-rate)
        total = p
        while total <= u:
            times += 1
            p *= rate / times
            total += p
        out += [(*r, k, hashlib.md5(f"17-order:{'' if r[0] is None else r[0]}:{k}".encode()).hexdigest()) for k in range(1, times + 1)]
    return out


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, lambda df: [tuple(r) for r in df.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]

    clean = stages["toxicity"](spark, docs, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    same(rows(clean), [r for r in rows(docs) if model.score(r[1]) < 0.5])
    left = {r[0] for r in rows(clean)}
    assert not {k for k in range(0, 360, 6)} & left and {k for k in range(360) if k % 6} <= left

    lined = stages["line_dedup"](spark, clean, sf_dir)
    first = min(r[0] for r in rows(clean) if r[1] and r[1].startswith("Subscribe"))
    cut = lambda r: r if not r[1] or not r[1].startswith("Subscribe") or r[0] == first else (r[0], t := r[1].split("\n", 1)[1], *r[2:4], len(t))
    same(rows(lined), map(cut, rows(clean)))

    near = stages["near_dedup"](spark, lined, sf_dir)
    texts = [(r[0], r[1], r[3]) for r in rows(lined)]
    ids = {c for _, _, c in brute_components(texts, 5, 80)}
    same(rows(near), [r for r in rows(lined) if r[0] in ids])
    assert len(ids) < len(texts)

    item = re.findall(ALNUM, spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text.translate(LOWER))
    grams = {" ".join(item[i : i + 10]) for i in range(len(item) - 9)}
    hit = lambda t: (w := re.findall(ALNUM, (t or "").translate(LOWER))) and any(" ".join(w[i : i + 10]) in grams for i in range(len(w) - 9))
    decontaminated = stages["decontamination"](spark, near, sf_dir)
    same(rows(decontaminated), [r for r in rows(near) if not hit(r[1])])
    assert decontaminated.count() < near.count()
    for df in (clean, lined, near, decontaminated):
        assert df.columns == columns

    mixed = stages["mixing"](spark, decontaminated, sf_dir)
    same(rows(mixed), brute_mix(rows(decontaminated)))
    same(rows(corpus_pipeline.run(spark, sf_dir)), rows(mixed))


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_run_leaves_what_its_result_reads(spark, sf_dir):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    result = corpus_pipeline.run(spark, sf_dir)
    left = {p.name for p in shared.iterdir()} - before
    assert left == {f.rsplit("/", 2)[1] for f in result.inputFiles()}
    assert {x.rsplit("-", 1)[0] for x in left} == {"stage-decontamination", "rates"}
    assert result.count() > 0
