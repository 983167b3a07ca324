"""Trie-node pairs against comparing every word with every other."""

import random
import re
import zlib
from collections import Counter

from tidepool.llm import spelling

from .brute import LOWER, canon, docs_frame, edge_docs, empty_docs

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(docs, every):
    out = Counter()
    for i, text in docs:
        for run in RUNS.findall(text or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % every == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            out[low] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    links = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in links.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(links[w]), words[form[w]] if form[w] else None))
    return out


def near_copies(seed, n):
    """Words a few edits apart, with runs of equal letters, and counts that make chains of forms."""
    pick = random.Random(seed)
    out = {"aaaaaa", "aaaaaaa", "aaaaaaaa", "aabbaab", "abcdef", "zabcdef", "abcdefz", "é" * 7, "é" * 8, "ÿ" * 6}
    while len(out) < n:
        w = list(pick.choice(sorted(out)))
        at = pick.randrange(len(w))
        how = pick.randrange(3)
        w[at:at + (how != 0)] = [pick.choice("abcé")] * (how != 1)
        if len(w) >= 6:
            out.add("".join(w))
    return {w: 5 ** pick.randint(1, 6) + pick.randint(0, 3) for w in out}


def test_every_kind_of_edit(spark):
    words = near_copies(1, 400)
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    got = spelling.forms_of(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(words)
    assert canon(got.collect()) == canon(want)
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain


def test_nodes_are_shared_by_ranges(spark):
    """Prefixes that cross from one range to the next are one node."""
    words = [f"{'shared' * 3}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = spelling.by_range(spark.createDataFrame([(w, 9) for w in words], "word string, n long"), "word").withColumnRenamed("at", "id")
        assert ranges.select("part").distinct().count() > 1
        rows = {r.id: r.word for r in ranges.collect()}
        assert [rows[k] for k in sorted(rows)] == sorted(words)
        nodes = {}
        for r in spelling.trie_paths(ranges, "word").collect():
            for k, node in enumerate(r.path):
                nodes.setdefault(node, set()).add(rows[r.id][:k])
        assert all(len(p) == 1 for p in nodes.values())
        assert len(nodes) == len({w[:k] for w in words for k in range(len(w) + 1)})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_documents(spark):
    """Lost letters by document, case, letters outside a-z, nulls, repeated rows, a very long word."""
    pick = random.Random(2)
    vocabulary = ["reading", "readings", "Éclairés", "naïvely", "STRASSE", "straße", "x×yz÷abc"]
    rows = edge_docs() + [(1000 + i, " ".join(pick.choices(vocabulary, k=30)) + ", " + "b" * 3000, "en", "s") for i in range(60)]
    docs = [(i, t) for i, t, _, _ in rows]
    for every in (199, 3):
        got = spelling.variants(docs_frame(spark, rows), lost_every=every)
        assert canon(got.collect()) == canon(brute(words_of(docs, every)))


def test_empty(spark):
    assert spelling.variants(empty_docs(spark)).count() == 0
    assert spelling.variants(docs_frame(spark, [(1, None, "en", "s"), (2, "", "en", "s"), (3, "one two", "en", "s")])).count() == 0
