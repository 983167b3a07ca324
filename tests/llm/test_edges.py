"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing names, and empty tables."""

import numpy as np
import pytest

from tidepool.llm import decontaminate, fingerprint, jaccard, line_dedup, mixing, pii, quality, substring_dedup

from . import brute
from .brute import canon, docs_frame, edge_docs, empty_docs, prose

BENCH = [(1, " ".join(prose(1, 40).split()[5:30])), (2, "One TWO"), (3, None), (4, "..."), (10, prose(77, 12)), (None, "é İ")]


def pairs():
    return [(i, t) for i, t, _, _ in edge_docs()]


def bench_frame(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def test_decontaminate(spark):
    got = decontaminate.report(docs_frame(spark), bench_frame(spark)).collect()
    want = brute.decontaminated(pairs(), [b for b in BENCH if b[0] is not None])
    by_null = brute.decontaminated(pairs(), BENCH)  # words hit by the item without an id count, the item is not listed
    want = [(w[0], w[1], n[2], w[3], w[4], n[5]) for w, n in zip(want, by_null)]
    assert canon(got) == canon(want)
    shuffled = decontaminate.report(docs_frame(spark), bench_frame(spark), max_broadcast_bytes=0).collect()
    assert canon(shuffled) == canon(want)


def test_decontaminate_all_lengths_in_one_pass(spark):
    docs = [(1, "a b c d e"), (2, "x a b"), (3, "b"), (4, "c d"), (5, "d e a b c"), (6, "B, a; B! a b c d"), (7, ""), (8, None)]
    bench = [(10, "a b c d"), (11, "b c"), (12, "e"), (13, "x a b"), (14, "b a b a")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    for room in (64 << 20, 0):
        got = decontaminate.report(frame, items, n=4, max_broadcast_bytes=room).collect()
        assert sorted(tuple(r) for r in got) == sorted(brute.decontaminated(docs, bench, 4))
    found = decontaminate.occurrences(frame, items, n=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(CASE") == 1  # the texts are gone through once for all lengths


def test_decontaminate_drop_and_cut(spark):
    docs, bench = docs_frame(spark), bench_frame(spark)
    bad = {w[0] for w in brute.decontaminated(pairs(), BENCH) if w[5]}
    kept = decontaminate.drop_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in pairs() if not (i in bad and t))
    rows = {r.doc_id: r.text for r in decontaminate.drop_spans(docs, bench).collect()}
    assert rows[7] == " " and rows[8] == " "
    assert rows[4] is None and rows[14] == "a" * 50_000
    w = prose(1, 120).split()
    assert rows[1].split() == w[:5] + w[30:]


def test_line_dedup(spark):
    got = line_dedup.report(docs_frame(spark)).collect()
    assert canon(got) == canon(brute.lines_deduped(pairs()))
    docs = docs_frame(spark)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[4].text is None and rows[100].n_chars == len(rows[100].text) and rows[100].row == -1


def test_line_dedup_bitmaps_round_trip(spark):
    row = spark.range(1).selectExpr("array(0, 1, 4, 6) as d", "7 as n").select(
        line_dedup.keep_runs(line_dedup.F.col("d"), line_dedup.F.col("n")).alias("r")).first()
    assert [tuple(x) for x in row.r] == [(2, 2), (5, 1)]


def test_substring_dedup(spark):
    want = canon(brute.substrings_deduped(pairs()))
    assert canon(substring_dedup.report(docs_frame(spark)).collect()) == want


def test_substring_dedup_with_a_full_sketch(spark, monkeypatch):
    """A sketch far too small sends all windows to the exact pass; none is lost."""
    rows = [(i, prose(i % 5, 400, 30) + " " + prose(8, 60), "en", "s") for i in range(40)]
    got = substring_dedup.report(docs_frame(spark, rows), max_cells=1, shard_bytes=1000)
    assert canon(got.collect()) == canon(brute.substrings_deduped([(i, t) for i, t, _, _ in rows]))


def test_substring_dedup_of_many_tables_in_one_session(spark):
    """Each table has a sketch of its own; a scan that runs again has it, too."""
    for k in range(5):
        rows = [(1, f"a{k} " + prose(k, 13, 10 ** 6), "en", "s"), (2, prose(k, 13, 10 ** 6) + f" b{k}", "en", "s")]
        out = substring_dedup.report(docs_frame(spark, rows))
        want = canon(brute.substrings_deduped([(i, t) for i, t, _, _ in rows]))
        assert sum(r[2] for r in want) == 13
        assert canon(out.collect()) == want and canon(out.collect()) == want
    docs = docs_frame(spark)
    bits = substring_dedup.sketch_bits(1000, 1 << 29)
    shared = spark.sparkContext.broadcast(("own", substring_dedup.sketch(docs, 13, bits)))
    found = substring_dedup.repeated_windows(docs, 13, bits, shared, 4)
    assert found.count() == found.count() == found.count() > 0


def test_positions_as_steps():
    docs = [([0], 1), ([5], 1), ([0, 1, 2, 255, 510, 511, 5000], 2), ([254, 255, 256, 100_000], -3)]
    rows = [(i, k, x) for k, (at, i) in enumerate(docs) for x in at]
    ids, keys, at = (np.array(c, np.int64) for c in zip(*rows))
    mixed = np.random.default_rng(1).permutation(len(rows))
    steps, ends, counts, i, k = substring_dedup.by_document(ids[mixed], keys[mixed], at[mixed])
    back = np.split(substring_dedup.positions_of(steps, counts), np.cumsum(counts)[:-1])
    assert {int(key): list(map(int, b)) for key, b in zip(k, back)} == {key: at for key, (at, _) in enumerate(docs)}
    parts = np.split(steps, ends[:-1])
    assert {int(key): substring_dedup.positions_of(b).tolist() for key, b in zip(k, parts)} == {key: at for key, (at, _) in enumerate(docs)}


def test_substring_dedup_groups_by_sub_ranges(spark, monkeypatch):
    rows = [(i, prose(i % 5, 400, 30) + " " + prose(8, 60), "en", "s") for i in range(40)]
    want = canon(brute.substrings_deduped([(i, t) for i, t, _, _ in rows]))
    monkeypatch.setattr(substring_dedup, "SUB_RANGE", 50)
    assert canon(substring_dedup.report(docs_frame(spark, rows), shard_bytes=10_000).collect()) == want


def test_jaccard(spark):
    got = jaccard.report(docs_frame(spark))
    assert canon(got.collect()) == canon(brute.joined(pairs()))


@pytest.mark.parametrize("part_tokens", [1, 300, 100_000])
def test_jaccard_blocks_in_parts(spark, part_tokens):
    """Chains and groups of near copies, blocks cut into many parts, nothing broadcast."""
    rows = []
    for g in range(4):
        words = prose(50 + g, 100).split()
        for i in range(15):  # each two words further from the first
            words = [*words[:i * 6], f"n{g}_{i}", *words[i * 6 + 1:]]
            rows.append((g * 100 + i, " ".join(words), "en", "s"))
    rows += [(900 + i, prose(60, 46) + " " + prose(200 + i, 20), "en", "s") for i in range(20)]  # a passage shared by many
    got = jaccard.report(docs_frame(spark, rows), part_tokens=part_tokens, max_broadcast_rows=0 if part_tokens == 1 else 1000,
                         max_broadcast_tokens=0 if part_tokens == 1 else 1000)
    assert canon(got.collect()) == canon(brute.joined([(i, t) for i, t, _, _ in rows]))


def test_jaccard_keeps_one_of_each(spark):
    docs = docs_frame(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute.joined(pairs())
    full = {(i, c) for (i, n, c) in want if n}
    named = {c for _, c in full}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in named) == sorted(named)
    empties = [i for i, n, _ in want if not n]
    assert kept.count() == len(named) + len(empties)


def test_fingerprints(spark):
    got = fingerprint.report(docs_frame(spark)).collect()
    rows = pairs()
    assert len(got) == len(rows)
    alike = {}
    for r in got:
        if r.doc_id is not None:
            text = next(t for i, t in rows if i == r.doc_id) or ""
            assert r.n_chars == len(text)
            assert alike.setdefault(text, r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_id = {r.doc_id: r for r in got}
    ordered = sorted({(i, t or "") for i, t in rows if i is not None})
    for (i, t), (_, after) in zip(ordered, ordered[1:]):
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert by_id[i].edited_sha256 == brute.sha(edited), i
    assert by_id[1].near_next == 1.0 and by_id[5].fingerprint == "0" * 16


def test_neighbours_of_documents(spark):
    """n_near by brute force: other fingerprints within 3 bits, copies of a document are one."""
    rows = [(i, " ".join(f"longerword{k}" for k in range(400)) + f" x{i // 2}", "en", "s") for i in range(24)] + [(90, None, "en", "s"), (91, prose(3, 50), "en", "s")]
    got = fingerprint.report(docs_frame(spark, rows)).collect()
    prints = {int(r.fingerprint, 16) for r in got}
    assert {r.doc_id: r.n_near for r in got} == {
        r.doc_id: sum(0 < (p ^ int(r.fingerprint, 16)).bit_count() <= 3 for p in prints) for r in got}
    assert any(r.n_near for r in got)


def test_the_order_does_not_change_with_the_number_of_ranges(spark):
    """Null ids come last, however many ranges the ids are cut into."""
    rows = [(i, prose(i, 5 + i), "en", "s") for i in range(40)] + [(None, prose(90 + i, 30), "en", "s") for i in range(3)]
    got = {k: canon(fingerprint.report(docs_frame(spark, rows), rows_per_bucket=k).collect()) for k in (5, 500_000)}
    assert got[5] == got[500_000]
    turns = fingerprint.successors(docs_frame(spark, rows), rows_per_bucket=5).collect()
    keyed = docs_frame(spark, rows).select(fingerprint.row_key(fingerprint.F.col("doc_id"), fingerprint.F.col("text")).alias("row"), "doc_id").collect()
    order = [r.row for r in sorted(keyed, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.row))]
    assert {r.row: r.next_row for r in turns} == dict(zip(order, order[1:] + order[:1]))


def test_near_pairs_find_all_in_radius(spark):
    rows, x = [], 12345
    for i in range(60):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        rows += [x, x ^ (1 << (i % 64)), x ^ (7 << (i % 60)), x ^ (15 << (i % 60)), x]
    prints = spark.createDataFrame([(v >> 32, v & 0xFFFFFFFF) for v in rows], "hi long, lo long")
    got = {((r.hi_a << 32) + r.lo_a, (r.hi_b << 32) + r.lo_b, r.distance) for r in fingerprint.near_pairs(prints).collect()}
    values = sorted(set(rows))
    want = {(a, b, (a ^ b).bit_count()) for k, a in enumerate(values) for b in values[k + 1:] if (a ^ b).bit_count() <= 3}
    assert got == want


def test_pii_edges(spark):
    got = {r.doc_id: r for r in pii.spans(docs_frame(spark)).collect()}
    assert got[4].spans == "" and got[4].base_sha256 == brute.sha("")
    assert got[14].n_email == 0


def test_mixing(spark):
    docs = docs_frame(spark)
    rows = mixing.assign(docs).collect()
    assert len(rows) == docs.count()
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
        assert sum(c["take"] for c in r.copies) == r.taken
    sizes = {s: sum(r.size for r in rs) for s, rs in by_source.items()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:  # share, stop at the brim, share the excess again
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        level = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] >= 2 * sizes[s]}
        if not over:
            target |= level
            break
        target |= {s: 2 * sizes[s] for s in over}
        free -= over
    for s, rs in by_source.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert all(abs(r.target - target[s]) < 1e-6 for r in rs)
        assert abs(sum(r.taken for r in rs) - target[s]) <= 0.5
    again = mixing.assign(docs.repartition(7)).collect()
    assert canon((r.doc_id, r.taken) for r in again) == canon((r.doc_id, r.taken) for r in rows)


def test_sizes_are_counted_without_an_array_of_words(spark):
    texts = [None, "", " ", " \t\n\x0b\f\r", "a", "  a", "a  ", " a\n\tb\x0b\x0c\r ", "é ü\u00a0x y", "\x1c a\x1d b", "$1 \\ x", "\x00 \x00"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    sized = mixing.sizes(docs)
    assert [r.size for r in sized.orderBy("doc_id").collect()] == [0, 0, 0, 0, 1, 1, 1, 2, 3, 3, 3, 2]
    assert "regexp_extract_all" not in sized._jdf.queryExecution().executedPlan().toString()


def test_sizes_of_many_parts_are_staged_in_few_files(spark, monkeypatch):
    files, staged = [], mixing.stage

    def stage(df, name):
        out = staged(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(mixing, "stage", stage)
    docs = docs_frame(spark)
    assert len(mixing.assign(docs.repartition(40)).collect()) == docs.count()
    assert files[0] <= 8


def test_mix_report(spark):
    got = mixing.report(docs_frame(spark)).collect()
    assert len(got) == len(edge_docs())
    at = [r.position for r in got if r.position is not None]
    assert at == sorted(at) and all(r.position is None for r in got[len(at):])
    assert all((r.position is None) == (r.taken == 0) == (r.last_position is None) for r in got)
    want = {}
    for i, _, size, _, take, position in brute.mixed([(i, s, t) for i, t, _, s in edge_docs()]):
        first, words = want.get((i, size, "first"), position), want.get((i, size, "taken"), 0)
        want |= {(i, size, "first"): first, (i, size, "taken"): words + take, (i, size, "last"): position}
    for r in got:  # rows of one id and size (the repeated row) share their words
        if r.taken and r.doc_id != 16:
            assert r.taken == want[r.doc_id, r.size, "taken"]
            assert abs(r.position - want[r.doc_id, r.size, "first"]) < 1e-9
            assert abs(r.last_position - want[r.doc_id, r.size, "last"]) < 1e-9
    taken = sum(r.taken for r in got)
    assert taken == sum(n for key, n in want.items() if key[2] == "taken")


def test_mix_is_ordered_and_follows_the_schedule(spark):
    rows = [(i, prose(i, 10), "en", f"s{i % 3}") for i in range(900)]
    order = mixing.mix(docs_frame(spark, rows)).collect()
    at = [r.position for r in order]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    third = len(order) // 3
    share = lambda part, s: sum(r.take for r in part if r.source == s) / sum(r.take for r in part)
    assert share(order[:third], "s0") > share(order[-third:], "s0")  # heavy early
    assert share(order[:third], "s2") < share(order[-third:], "s2")


def test_schedule_inverse(spark):
    schedule = ((0.0, (2.0,)), (0.25, (0.0,)), (0.5, (1.0,)), (1.0, (1.0,)))
    whole = mixing.total(schedule, 0)
    cum = lambda t: min(t, .25) * 2 - 4 * min(t, .25) ** 2 + (2 * (min(t, .5) - .25) ** 2 if t > .25 else 0) + max(0, t - .5)
    q = [i / 50 for i in range(51)]
    frame = spark.createDataFrame([(x,) for x in q], "q double")
    got = [r.t for r in frame.select(mixing.invert(schedule, 0, mixing.F.col("q")).alias("t")).collect()]
    assert all(abs(cum(t) / whole - x) < 1e-9 for x, t in zip(q, got))


def test_empty_tables(spark):
    none, bench = empty_docs(spark), bench_frame(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (decontaminate.report(none, bench), decontaminate.drop_documents(none, bench), line_dedup.report(none),
                line_dedup.dedup_lines(none), mixing.report(none), mixing.mix(none), quality.report(none, labels),
                pii.spans(none), substring_dedup.report(none), fingerprint.report(none), jaccard.report(none), jaccard.keep_one(none)):
        assert out.count() == 0
    no_bench = bench.limit(0)
    assert not any(r.contaminated for r in decontaminate.report(docs_frame(spark), no_bench).collect())
    alone = quality.report(docs_frame(spark), labels).collect()
    assert {r.score for r in alone} == {0.5}
