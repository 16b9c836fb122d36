from test_decontamination import brute as leaks_of
from test_jaccard import brute as groups_of
from test_mixing import SCHEMA, brute as mix_of
from test_pii import plain

import corpus_pipeline
from playtrail.llm import pii, toxicity

SF = "/root/testdata/sf0.01"


def masked(text):
    out, at, reach = [], 0, -1
    for kind, start, end in sorted(plain(text), key=lambda s: (s[1], -s[2])):
        if start >= reach:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = reach = max(reach, end)
    return "".join([*out, text[at:]]) if out else text


def test_run_is_the_chain_of_brute_forces(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    rows = [tuple(r) for r in docs.collect() if r.doc_id not in toxic]
    groups = {d: c for d, _, c in groups_of(rows)}
    rows = [r for r in rows if groups[r[0]] == r[0]]
    leaked = {d for d, _ in leaks_of(rows, [(r.item_id, r.text) for r in bench.collect()])}
    rows = [r for r in rows if r[0] not in leaked]
    assert toxic and leaked and not any(s[0] not in pii.BASE for r in rows for s in pii.find(r[1]))
    rows = [(i, masked(text), lang, source, n if masked(text) == text else len(masked(text))) for i, text, lang, source, n in rows]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]
    got = out.collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(rows)
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == mix_of(rows)


def test_stages_on_odd_tables(spark, frame):
    docs = frame([(1, "a b c", "en", None, 5), (1, "a b c", "en", None, 5), (2, None, None, "s", None), (None, "", "en", "s", 0)], SCHEMA).selectExpr("*", "1 as content", "2 as target", "3 as _content", "4 as _grp", "5 as c0", "6 as kept_id")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, rows, SF)
            assert set(docs.columns) - {"target"} <= set(kept.columns) and kept.count() <= rows.count()
            assert all((r._content, r._grp, r.c0, r.kept_id) == (3, 4, 5, 6) for r in kept.collect())
            if name != "mixing":
                assert kept.columns == docs.columns
