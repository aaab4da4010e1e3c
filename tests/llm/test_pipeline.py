import importlib
import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from helpers import awkward_docs, frame
from test_decontaminate import brute as contamination
from test_leaks import LIVE, SHARED
from test_mixing import targets
from test_simhash import expected as components

from tidemark.llm import leaks, quality

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ITEM = "the quick brown fox jumps over the lazy dog while seven owls watch from trees"


def corpus():
    rows = awkward_docs()
    rows += [(500 + k, f"Number {k} speaks of many things that differ, line {k * k} and {k * 7}, with ending words {k * 13}.", "en", "abcdef"[k % 6], 5) for k in range(60)]
    rows += [(600, f"He said that {ITEM} again and then left.", "en", "a", 1), (601, f"One two three four five six seven {LIVE} and more of it.", "en", "b", 1)]
    rows += [(610 + k, f"Example number {k} in the manual shows that {SHARED} is how it is written down {k}.", "en", "abcdef"[k], 1) for k in range(6)]
    rows += [(620, "This line of plain words is kept for its words.\na### b*** c%%% d### e$$$\nAnother plain line ends the text here.", "en", "c", 1)]
    return rows


def steps(rows, items):
    """The stages by brute force on rows (doc_id, text, ...)."""
    out = []
    for r in rows:
        got = quality.judge(r[1] or "", quality.MAX_LOSS)
        if got["kept"]:
            out.append((r[0], got["clean_text"]) + r[2:4])
    rows, out = out, []
    comp = {}
    for (i, print_, c) in components(rows):
        comp[(i, print_)] = c
    from test_simhash import fingerprint, roots

    root = roots([fingerprint(r[1]) for r in rows])
    groups = {}
    for r in rows:
        groups.setdefault(root[fingerprint(r[1])], []).append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    bad = {(x[0]) for x in contamination(rows, items) if x[5]}
    rows = [r for r in rows if r[0] not in bad]
    owners = {}
    found = {}
    import re

    from test_leaks import KINDS

    for r in rows:
        for kind, (p, group, least) in KINDS.items():
            for m in p.finditer(r[1]):
                if len(m[group]) >= least:
                    value = m[group].rstrip(".")
                    owners.setdefault(value, set()).add(r[3])
                    found.setdefault(r[0], []).append((m.start(), m.end(), value))
    out = []
    for r in rows:
        text, at, pieces = r[1], 0, []
        for a, b, v in sorted(found.get(r[0], [])):
            if len(owners[v]) < leaks.EXAMPLE_OWNERS and len(set(v)) >= leaks.MIN_DISTINCT_CHARS and a >= at:
                pieces += [text[at:a], leaks.MARK]
                at = b
        out.append((r[0], "".join(pieces) + text[at:], r[3]))
    return [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1])), r[2]) for r in out]


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows, items = corpus(), [(1, ITEM), (2, "nothing of this stands anywhere")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = steps(rows, items)
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, n) for i, n, _ in want)
    sizes = Counter()
    for _, n, s in want:
        sizes[s] += n
    goal = targets(sizes)
    assert sorted((r.doc_id, r.size, round(r.target, 6)) for r in got) == sorted((i, n, round(goal[s], 6)) for i, n, s in want)
    ids = {r.doc_id for r in got}
    assert 600 not in ids and 601 in ids and 620 in ids


def test_stages_keep_the_columns(spark, tmp_path):
    docs = frame(spark, corpus())
    for name in ("row", "kept", "hits", "items", "spans", "text_key", "fp", "root", "n_words", "odd name-1"):
        docs = docs.withColumn(name, F.lit("clash"))
    frame(spark, [(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        empty = function(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0 and empty.dtypes == docs.dtypes
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "mixing_sources"]


def test_entry_registers_the_corpus_queries():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names if k.startswith("op")}
    assert "pipeline" in names and "op6_url_rules" in entry.oracle_sql()


def test_entry_works_without_the_corpus_folders(tmp_path):
    for name in ("__spark_entry__.py", "tidemark"):
        os.symlink(f"{HERE}/{name}", f"{tmp_path}/{name}")
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith('tidemark.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "q = e.queries(); assert 'customer_features' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
