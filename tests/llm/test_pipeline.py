"""Pipeline stages against plain Python, and the names the driver looks for."""

import glob
import itertools
import json
from collections import Counter

import numpy as np
import pytest
from test_text_operators import bag, closure, plain_leaks, weighted_jaccard, words

import __spark_entry__
import corpus_pipeline
from shelfwise.llm import mixing, token_output, toxicity
from shelfwise.llm.common import Scratch, read, small_batches, shared_dir

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage."""
    docs, out = read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "test").table(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def test_entry_names():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontaminate", "mix", "token_shards"]


def test_stages_like_plain_python(spark, stages):
    rows = lambda df: [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    docs = read(small_batches(spark), SF, "documents")
    for name in ("toxicity", "near_dup", "decontaminate", "mix"):
        assert stages[name].columns == COLUMNS
    model = toxicity.fit_on_tables(spark, docs, SF)
    all_rows = rows(docs)
    score = model.logits([r[1] for r in all_rows])
    assert Counter(rows(stages["toxicity"])) == Counter(r for r, s in zip(all_rows, score, strict=True) if s < 0)

    before, after = rows(stages["toxicity"]), rows(stages["near_dup"])
    bags = [bag(r[1]) for r in before]
    pairs = [
        p for p in itertools.combinations(range(len(before)), 2)
        if bags[p[0]] and bags[p[1]] and weighted_jaccard(bags[p[0]], bags[p[1]]) >= 0.8
    ]
    groups = {}
    for r, top in zip(before, closure(len(before), pairs), strict=True):
        groups.setdefault(top, []).append(r)
    assert Counter(after) == Counter(min(g, key=lambda r: r[0]) for g in groups.values())

    items = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    leaky = plain_leaks([r[:2] for r in after if len(words(r[1])) < 1500], items)
    clean = rows(stages["decontaminate"])
    assert Counter(r for r in after if len(words(r[1])) < 1500 and r[0] not in {d for d, _ in leaky}) == Counter(
        r for r in clean if len(words(r[1])) < 1500
    )
    copies = Counter()
    for r in mixing.mix(stages["decontaminate"], Scratch(spark, "t")).collect():
        copies[tuple(r[c] for c in COLUMNS)] += r["copies"]
    assert Counter(rows(stages["mix"])) == +copies


def test_last_stage_writes_the_mix(spark, stages):
    scratch = Scratch(spark, "t")
    listed = token_output.materialise(stages["mix"], scratch).collect()
    assert Counter(r["crc32"] for r in listed) == Counter(r["crc32"] for r in stages["token_shards"].collect())
    root = scratch.root.removeprefix("file:")
    layout = json.load(open(glob.glob(f"{root}/layout/*.json")[0]))
    stream = np.concatenate(list(token_output.read_from(root, 0, layout)))
    ends = len(listed) * token_output.LENGTH - sum(r["n_tokens"] for r in listed)
    assert int((stream == token_output.END).sum()) == stages["mix"].count() + ends


def test_run_reads_whole_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and shared_dir(spark)
