"""The pipeline, stage by stage, against brute force over each stage's own input."""

import corpus_pipeline as P
from tidepool.llm.common import stage, table

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    kept = {}
    for name, step in P.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        sourced = [(r.doc_id, r.source, r.text) for r in docs.collect()]
        docs = stage(step(spark, docs, SF), "test")
        kept[name] = docs
        if name != names[-1]:
            assert docs.columns == columns
        got = {r.doc_id: r for r in docs.collect()}
        if name == names[0]:
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            known = [(i in got) == bool(labels[i]) for i, _ in rows if i in labels]
            assert sum(known) >= 0.9 * len(known)
        elif name == names[1]:
            assert {i: brute.sha(r.text or "") for i, r in got.items()} == {w[0]: w[3] for w in brute.lines_deduped(rows)}
            assert all(r.n_chars == len(r.text) for r in got.values())
        elif name == names[2]:
            want = brute.joined(rows)
            assert set(got) == {c for _, n, c in want if n} | {i for i, n, _ in want if not n}
        elif name == names[3]:
            bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            assert set(got) == {w[0] for w in brute.decontaminated(rows, bench) if not w[5]}
        else:
            assert docs.columns == ["doc_id", "source", "size", "copy", "take", "position"]
            copies = sorted(map(tuple, docs.collect()), key=lambda r: (r[0], r[3]))
            want = sorted(brute.mixed(sourced), key=lambda r: (r[0], r[3]))
            assert [r[:5] for r in copies] == [w[:5] for w in want]
            assert all(abs(r[5] - w[5]) < 1e-9 for r, w in zip(copies, want))
    again = P.run(spark, SF).collect()
    assert [(r.doc_id, r.copy, r.take) for r in again] == [(r.doc_id, r.copy, r.take) for r in
                                                          kept[names[-1]].orderBy("position", "doc_id", "copy").collect()]


def test_stage_list():
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
