import re

import corpus_pipeline as C
from lumbre.llm.query_secrets import secret_model
from lumbre.llm.secrets import scan
from tests.llm.conftest import SF
from tests_llm_words import tokens
from test_jaccard import brute as classes
from test_secrets import base
from tokenizers import Tokenizer


def test_each_stage_on_what_the_one_before_kept(spark, documents):
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    kept = [documents]
    for name, stage in C.STAGES:
        kept.append(C.save_scratch(stage(spark, kept[-1], SF), name))
        if name != "tokens":
            assert kept[-1].columns == documents.columns
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]
    assert all(len(r) == df.count() for r, df in zip(rows, kept, strict=True))
    raw, good, single, clean, masked, coded = rows

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [i for i, q in labels.items() if (i in good) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels) and all(good[i] == raw[i] for i in good)

    assert set(single) == {c for _, c, _ in classes([(i, r.text) for i, r in good.items()])}

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        own = tokens(r.text)
        windows |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9))}
    hit = lambda t: any(tuple(own[k : k + 10]) in windows for own in [tokens(t)] for k in range(len(own)))
    assert set(clean) == {i for i, r in single.items() if not hit(r.text)}

    added = {r.id: r.added for r in scan(kept[3], secret_model(kept[3])).collect()}
    for i, r in clean.items():
        spans = base(r.text)
        assert (masked[i].text == r.text) == (not spans and not added[i])
        assert not spans or not re.search(r"[0-9a-f]{24}", masked[i].text)
        assert masked[i].n_chars == len(masked[i].text)

    library = Tokenizer.from_str(C.vocabulary())
    assert set(coded) == set(masked)
    for i, r in coded.items():
        assert r["ids"] == library.encode(masked[i].text, add_special_tokens=False).ids and r.n_tokens == len(r["ids"])


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])
    assert C.run(spark, SF).columns == ["doc_id", "n_tokens", "ids"]
