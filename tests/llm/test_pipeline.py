import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import jaccard_brute, lines_brute, sha
from test_models import brute_rates, fitted_rates, verdicts_brute

import corpus_pipeline
from towerline.llm import mixing, perplexity
from towerline.llm.common import durable
from towerline.llm.queries import label_domain
from towerline.llm.queries import vocabulary as vocabulary_file

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "BPE encoding and decoding"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF))
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == sizes[-1]
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_each_stage_keeps_what_brute_force_keeps(spark, tmp_path):
    """Chained on a small corpus: each stage against its brute-force version on its input."""
    rnd = random.Random(20)
    vocabulary = {x: ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(60)] for x, letters in (("en", "abcdefgh"), ("fr", "élmnopqr"))}
    text = lambda x, n: " ".join(rnd.choice(vocabulary[x]) for _ in range(n))
    common = "a line that is found in many documents of this corpus"
    rows = []
    for i in range(60):
        x = "en" if i % 3 else "fr"
        t = text(x, rnd.randint(30, 60)) + (f"\n{common}\n{text(x, 8)}" if i % 5 == 0 else "")
        rows.append((i, t, x))
    rows += [(100 + i, rows[i][1] + (" tail" if i % 2 else ""), rows[i][2]) for i in range(12)]
    rows += [(200, " ".join("#$%&" + rnd.choice("XYZ") * 5 for _ in range(50)), "en"), (201, "too short", "en"), (202, None, "fr"), (203, "", None), (None, rows[3][1], "en")]
    data = [(i, t, x, "s", len(t or "")) for i, t, x in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, int(i % 4 != 1), int(i % 7 == 2)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(data, schema)
    stage = dict(corpus_pipeline.STAGES)
    listed = lambda d: sorted((r["doc_id"], r["text"]) for r in d.collect() if r["doc_id"] is not None)

    halves = [(r["lang"], r["text"], r["half"]) for r in perplexity.keyed(docs, "text", "lang").collect()]
    verdict = verdicts_brute([(k, *h) for k, h in enumerate(halves)])
    judged = durable(stage["quality rules"](spark, docs, str(tmp_path)))
    assert sorted((r["doc_id"] or -1, r["text"]) for r in judged.collect()) == sorted((i or -1, t) for k, (i, t, *_) in enumerate(data) if verdict[k][1])

    lined = durable(stage["line dedup"](spark, judged, str(tmp_path)))
    want = lines_brute([(r["doc_id"], r["text"]) for r in judged.collect()])
    assert sorted(((r["doc_id"], r["text"]) for r in lined.collect()), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr) and sum(w[2] for w in want)

    single = durable(stage["n-gram Jaccard join"](spark, lined, str(tmp_path)))
    has = [(r["doc_id"], r["text"]) for r in lined.collect()]
    classes = jaccard_brute(has)
    assert listed(single) == sorted(r for r in has if r[0] is not None and (r[0], r[0]) in {c[:2] for c in classes}) and single.count() < len(has)

    mixed = durable(stage["mixing to target weights"](spark, single, str(tmp_path)))
    domains = mixing.fit_domains(single, spark.read.parquet(f"{tmp_path}/labels.parquet"), label_domain())
    table = mixing.memberships(single, domains, columns={"i": F.col("doc_id"), "t": F.col("text"), "u": mixing.hash_unit(F.col("doc_id"), F.col("text"), seed=66)}).collect()
    tokens, posterior = np.array([float(r["__tokens"]) for r in table]), np.array([r["__posterior"] for r in table])
    goal = (tokens @ posterior) * [corpus_pipeline.KEEP.get(k, 1.0) for k in domains.names]
    rate = fitted_rates(spark, tokens, posterior, goal, 1.0)
    gap = lambda r: np.linalg.norm((tokens * r) @ posterior - goal)
    assert gap(rate) <= gap(brute_rates(tokens, posterior, goal, 1.0)) * 1.01 + 1e-6
    left = sorted(((r["i"], r["t"]) for r, x in zip(table, rate, strict=True) if np.floor(x + r["u"]) >= 1), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in mixed.collect()), key=repr) == left and len(left) < len(table)

    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_file())
    out = stage["BPE encoding and decoding"](spark, mixed, str(tmp_path))
    want = []
    for r in mixed.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_stages_take_empty_tables_and_odd_rows(spark, tmp_path, odd, empty):
    """Nulls, repeats, ties, long texts and clashing columns pass every stage."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (empty, odd):
        for _, make in corpus_pipeline.STAGES[:-1]:
            out = make(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
