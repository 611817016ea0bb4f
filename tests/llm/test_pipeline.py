"""The pipeline against a brute-force version of its stages on the smallest tables."""

import os
import re
import subprocess
import sys
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from quartermaster.llm import secrets

sys.path.insert(0, os.path.dirname(__file__))
from test_mixing import plain_targets  # noqa: E402
from test_simhash import by_hand, roots  # noqa: E402
from test_text_operators import plain_spans  # noqa: E402

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def good(text):
    w = words(text)
    n = len(w)
    windows = defaultdict(list)
    for i in range(n - 2):
        windows[tuple(w[i:i + 3])].append(i)
    repeated = {p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    letters = re.findall("[A-Za-z]", text)
    return not (n < 50 or 100 * len(repeated) > 50 * n or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
                or 2 * len(re.findall("[A-Z]", text)) > len(letters) or 2 * (len(lines) - len(set(lines))) > len(lines)
                or not 2 * n <= sum(map(len, w)) <= 40 * n)


def plain(docs, items):
    """{doc_id: (text, source)} before the mix."""
    kept = {i: (t or "", s) for i, (t, s) in docs.items() if good(t or "")}
    ids = sorted(kept)
    root, _ = roots([by_hand(kept[i][0]) for i in ids])
    kept = {i: kept[i] for k, i in enumerate(ids) if root[k] == k}
    tokens = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    held = [tokens(t) for t in items]
    kept = {i: (t, s) for i, (t, s) in kept.items() if not any(x in tokens(t) for x in held)}
    out = {}
    for i, (t, s) in kept.items():
        new, at = "", 0
        for a, b, *_ in plain_spans(t):
            if a >= at:
                new += t[at:a] + "[SECRET]"
            at = max(at, b)
        out[i] = (new + t[at:], s)
    return out


def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain(docs, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys()
    assert {i: r.size for i, r in got.items()} == {i: len(words(t)) for i, (t, _) in want.items()}
    sizes = defaultdict(int)
    for t, s in want.values():
        sizes[s] += len(words(t))
    goal = plain_targets(sizes)
    taken = defaultdict(int)
    for r in got.values():
        taken[r.source] += r.taken
        assert abs(r.target - goal[r.source]) < 1e-6 and r.source_size == sizes[r.source] and r.taken <= 3 * r.size
    largest = max(r.size for r in got.values())
    assert all(abs(taken[s] - goal[s]) <= largest for s in goal)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit("x"))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans",
        "mixing sources to target weights"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert sorted(out.columns) == sorted(docs.columns)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_secrets_are_gone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = secrets.redacted(spark, docs)
    assert secrets.scan(spark, clean).where(F.size("spans") > 0).count() == 0
    assert clean.where("n_chars <> length(text)").count() == docs.where("n_chars <> length(text)").count()


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    (tmp_path / "quartermaster").mkdir()
    for name in os.listdir(os.path.join(root, "quartermaster")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(root, "quartermaster", name), tmp_path / "quartermaster" / name)
    code = ("import sys; sys.path.insert(0, '.'); import importlib.util as u\n"
            "s = u.spec_from_file_location('entry', '__spark_entry__.py'); m = u.module_from_spec(s); s.loader.exec_module(m)\n"
            "q = m.queries(); assert 'spend_by_region' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)")
    text = open(os.path.join(root, "__spark_entry__.py")).read()
    (tmp_path / "__spark_entry__.py").write_text(text)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
