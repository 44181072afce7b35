"""Each stage of the pipeline on its own input, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gridloom.llm import mixing
from tests.llm.test_operators import near, shares, words


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ta", "ri", "mo", "ne", "ku", "so") for b in ("l", "nd", "ver", "s", "pa")]
    rows, labels = [], []
    for i in range(160):
        w = [r.choice(vocabulary) for _ in range(r.randint(20, 60))]
        if i % 4 == 0:
            w += ["moron", "loser"]
        if i % 5 == 1:
            w.insert(3, "me@mail.example.com")
        rows.append((i, " ".join(w), "en", f"s{i % 3}" if i % 7 else None, 0))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(200 + k, rows[k][1] + " extra", "en", "s0", 0) for k in (1, 2, 3, 5)] + [(300, None, "en", "s1", 0), (301, "", "en", "s1", 0), (302, "one", None, "s1", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {i for i in before if i >= 200 or i % 4}
    assert {r["doc_id"] for r in out["toxicity"]} == clean
    rows = [(i, before[i]["text"]) for i in sorted(clean)]
    kept = {i for i, _, c in near(rows, 5, 80) if i == c}
    assert sorted(r["doc_id"] for r in out["near_dedup"]) == sorted(kept) and 201 not in kept
    want = {i: re.sub("me@mail.example.com", "<EMAIL>", before[i]["text"]) if before[i]["text"] is not None else None for i in kept}
    assert {r["doc_id"]: r["text"] for r in out["pii"]} == want
    size = {i: len(words(t)) for i, t in want.items()}
    source = {i: before[i]["source"] for i in kept}
    order = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    sizes = [sum(size[i] for i in kept if source[i] == s) for s in order]
    targets = shares(sizes, [5, 2, 1, 5][: len(order)], 1.5 * sum(sizes), 2)
    taken = Counter()
    for r in out["mixing"]:
        taken[r["source"]] += len(words(r["text"]))
        assert words(want[r["doc_id"]])[: len(words(r["text"]))] == words(r["text"])
    assert all(abs(taken[s] - t) <= 1 for s, t in zip(order, targets))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in out["mixing"])
    assert sum(r["length"] for r in out["packing"]) == total
    per = Counter()
    for r in out["packing"]:
        per[r["sequence_id"]] += r["length"]
    assert max(per.values()) <= 1024 and len(per) <= np.ceil(total / 1024) + 1


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_mixing_cuts_a_long_boundary_document(spark):
    text = " \t" + "word  and\n" * 50_000
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, "few words " * 500, "en", "b", 5000)], "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r["doc_id"]: r for r in mixing.mix(docs, mixing.cycle_weights((5, 2, 1)), share=1.5, cap=2.0).where("partial > 0").collect()}
    got = [r for r in corpus_pipeline.mixing(spark, docs, "").where("doc_id = 1").collect() if r["text"] != text]
    n = taken[1]["partial"]
    assert n > 10_000 and len(got) == 1 and len(words(got[0]["text"])) == n and text.startswith(got[0]["text"]) and got[0]["n_chars"] == len(got[0]["text"])


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, words string, score string, kept string, size string"


def awkward(spark, rows):
    """Documents with columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * 6) for i, t, s in rows], AWKWARD)


def test_stages_on_awkward_rows(spark, sf_dir):
    long = "plain words here and there " * 4000
    r = random.Random(7)
    text = " ".join(r.choice(["ta", "ri", "mo", "ne", "ku", "so"]) + str(r.randint(0, 99)) for _ in range(60))
    rows = [(None, None, None), (None, None, "a"), (1, "", "a"), (1, "", "a"), (2, text, "a"), (2, "another text altogether with nothing in common", "b"), (None, text + " end", "b"), (3, text, None), (9, long, "a"), (9, long, "a"), (5, "mail me@mail.example.com", "b")]
    docs = awkward(spark, rows)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    key = lambda r: tuple((x is None, x) for x in r)
    out = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        df = stage(spark, docs, sf_dir)
        assert df.columns == columns
        out[name] = sorted((tuple(r)[:2] + (r["source"],) for r in df.collect()), key=key)
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    assert out["toxicity"] == sorted(rows, key=key)
    once = [(None, None, None), (None, None, "a"), (1, "", "a"), (2, text, "a"), (2, "another text altogether with nothing in common", "b"), (9, long, "a"), (5, "mail me@mail.example.com", "b")]
    assert out["near_dedup"] == sorted(once, key=key)  # 3 and the one without an id are near 2; rows alike are one
    assert out["pii"] == sorted([(i, t.replace("me@mail.example.com", "<EMAIL>") if t else t, s) for i, t, s in rows], key=key)
    taken = Counter()
    for i, t, s in out["mixing"]:
        assert (i, t, s) in rows or any(u and t and u.startswith(t) and (i, s) == (j, v) for j, u, v in rows)
        taken[s] += len(words(t))
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    order = ["a", "b", None]
    want = shares([size[s] for s in order], [5, 2, 1], 1.5 * sum(size.values()), 2)
    assert all(abs(taken[s] - t) <= 1 for s, t in zip(order, want))
    packed = corpus_pipeline.packing(spark, docs, sf_dir)
    assert packed.where("doc_id is null and length = 1").count() == 2 and packed.where("doc_id = 1").count() == 2
    assert corpus_pipeline.packing(spark, docs.where("false"), sf_dir).count() == 0
