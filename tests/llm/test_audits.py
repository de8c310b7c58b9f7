"""The audits and the mix against brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("lodestrata.llm")

from lodestrata.llm import divergence, filter_audit, mixing  # noqa: E402
from lodestrata.llm.frames import ship  # noqa: E402
from lodestrata.llm.text import column_texts  # noqa: E402

# Further columns have the names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, id string, part string, place long, n long, digest string, size string"
MORE = ("x", "y", 1, 2, "d", "z")


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, repeated ids and clashing names."""
    ship(spark)
    pick = random.Random(5)
    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünder", "ÄÄ", "ünder", "A", "b&b", "$5"]
    prose = lambda n: " ".join(pick.choices(words, range(len(words), 0, -1), k=n))
    rows = []
    for i in range(240):
        lang, source = pick.choice(["de", "en", "en", None]), pick.choice(["s1", "s1", "s2", "s3", "é", None, "", "s9"])
        rows.append((i, prose(pick.choice([0, 1, 30, 60, 200])), lang, source, *MORE))
    rows += [(1000 + i, pick.choice(rows)[1], "de", "s4", *MORE) for i in range(30)]
    rows += [(300, prose(9000), "en", "s1", *MORE), (301, "X" * 5000, "en", "s5", *MORE), (302, None, "fr", "s1", *MORE), (303, "...", "fr", "s2", *MORE)]
    rows += [(304, " \t\x0b\x0c\r\n", None, None, *MORE), (305, "a\x00b c", "en", "s1", *MORE), (None, rows[3][1], None, None, *[None] * 6), rows[5], rows[5]]
    rows += [(7, rows[9][1], "en", "s2", *MORE), (None, "", "en", None, *MORE)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def no_docs(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def divergence_by_force(rows, support, top):
    groups, found, langs = defaultdict(Counter), defaultdict(Counter), set()
    for row in rows:
        lang, text = row["lang"] or "", re.sub("[A-Z]", lambda m: m[0].lower(), row["text"] or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups[lang, row["source"] or ""].update(terms)
        found[lang].update(set(terms))
        langs.add(lang)
    kept = {lang: [t for t, n in found[lang].items() if n >= support] for lang in langs}

    def shares(counts, lang):
        size = sum(counts[t] for t in kept[lang]) + 5 * len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 5) // size for t in kept[lang]}

    whole = {lang: shares(sum((c for (g, _), c in groups.items() if g == lang), Counter()), lang) for lang in langs}
    own = {group: shares(counts, group[0]) for group, counts in groups.items()}
    out = []
    for lang, source in groups:
        p = own[lang, source]
        far = [(s, sum(abs(p[t] - own[g, s][t]) for t in kept[lang])) for g, s in groups if g == lang and s != source]
        near = [(t, p[t] - whole[lang][t]) for t in kept[lang] if groups[lang, source][t] and p[t] > whole[lang][t]]
        for part, items, most in (("pair", far, None), ("term", near, top)):
            ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


@pytest.mark.parametrize("support,top,tiling", [(30, 50, {}), (3, 4, {"tile": 2, "cells": 50, "block_words": 1}), (10**6, 50, {})])
def test_divergence(docs, support, top, tiling):
    """Also with tiles and matrices so small that every source has to be met across them."""
    found = divergence.divergence(docs, support=support, top_terms=top, **tiling)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == divergence_by_force(docs.collect(), support, top)


def test_joint_values_are_what_the_complements_leave():
    """Joint cells and complements together against a plain sum over all terms."""
    pick = np.random.default_rng(3)
    for _ in range(20):
        counts = pick.integers(0, 4, (2, 64))
        p = [10 * c + k for k, c in enumerate(counts)]
        sides = []
        for k in (0, 1):
            levels = np.unique(counts[k][counts[k] > 0])
            bits = np.array([sum(1 << int(t) for t in np.flatnonzero(counts[k] == n)) for n in levels], np.uint64)
            sides.append((np.zeros(len(levels), np.int64), 10 * levels + k, np.full(len(levels), k), bits))
        alone = sum(abs(p[k][t] - (1 - k)) for k in (0, 1) for t in range(64) if counts[k][t])
        lacking = 64 - sum(int((c > 0).sum()) for c in counts)
        assert lacking + alone + divergence.joint_values(*sides)[0, 0] == np.abs(p[0] - p[1]).sum()


def test_shares_are_exact_beyond_64_bits(spark):
    n, size = 10**13, 3 * 10**13
    row = spark.createDataFrame([(n, size)], "n long, size long").select(divergence.share("n", "size")).first()
    assert row[0] == 1 + 10**9 * (n + 5) // size


def test_counts_follow_the_documents(spark, docs):
    counted = divergence.term_counts(docs).where("term <> ''").collect()
    assert sum(r["n"] for r in counted) == sum(len(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r["text"] or "")) for r in docs.collect())


def audit_by_force(rows, labels):
    good, toxic = ({r["doc_id"] for r in labels if r[c] == 1} - {None} for c in ("quality", "toxic"))
    first = {}
    for row in rows:
        text = row["text"] or ""
        first[text] = min([i for i in (first.get(text), row["doc_id"]) if i is not None], default=None)
    parts = defaultdict(list)
    for row in rows:
        text, doc = row["text"] or "", row["doc_id"]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc is not None and first[text] < doc,
        }
        parts[row["source"] or ""].append(({f for f in fails if fails[f]}, doc in good, doc in toxic))
    out, shapley = [], Counter()
    for part, own in parts.items():
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [d for d in own if f in d[0] and not d[0] & before]
                out.append((part, "".join(order), k + 1, sum(not d[0] & {*before, f} for d in own), len(here), sum(f in d[0] and bool(d[0] & before) for d in own), sum(d[0] == {f} for d in own), sum(d[1] for d in here), sum(d[2] for d in here)))
                shapley[part, f] += len(here)
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in out)


LABELS = [(1, 1, 0), (1, 0, 1), (3, 0, 1), (5, 1, 1), (9, None, 1), (None, 1, 1), (1005, 1, None), (99999, 1, 1)]


def test_filter_interactions(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs, labels)
    wanted = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert found.columns == wanted
    assert sorted(tuple(r) for r in found.collect()) == audit_by_force(docs.collect(), labels.collect())


def test_words_that_share_a_name_get_columns_of_their_own(spark, docs):
    """With names of three values nearly all words clash; the matrix tells them apart all the same."""
    weak = lambda words: filter_audit.names_of(words) % np.uint64(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    plain, clashing = (sorted(tuple(r) for r in filter_audit.failures(docs, labels, **more).collect()) for more in ({}, {"name": weak}))
    assert plain == clashing


def test_matrix_rows_are_the_words_of_the_texts():
    texts = ["a b a", "", "  c\n", "b\x0bb  "]
    matrix = filter_audit.shard(column_texts(pa.array(texts)), {})
    assert matrix.row_sums().tolist() == [3, 0, 1, 3] and matrix.nonzeros().tolist() == [2, 0, 1, 2]
    names = dict(zip(["a", "b", "c", " "], filter_audit.names_of(pa.array(["a", "b", "c", " "])), strict=True))
    rows = [dict(zip(matrix.indices[a:b], matrix.data[a:b], strict=True)) for a, b in itertools.pairwise(matrix.indptr)]
    assert rows == [{names["a"]: 2, names["b"]: 1}, {}, {names["c"]: 1}, {names["b"]: 2, names[" "]: 1}]
    other = filter_audit.shard(column_texts(pa.array(texts)), {b"b": 7})
    assert 7 in other.indices and names["b"] not in other.indices


def targets_by_force(sizes):
    """By the rule: share by weight, stop at twice the size, share the excess again."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(ordered)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left, over = total - sum(2 * sizes[s] for s in full), sum(weight[s] for s in ordered if s not in full)
        share = {s: 2.0 * sizes[s] if s in full else weight[s] * left / over for s in ordered}
        above = {s for s in ordered if share[s] > 2 * sizes[s]}
        if not above:
            return share
        full |= above


def test_targets_are_shared_until_none_is_above(spark):
    pick = random.Random(8)
    for k in range(6):
        sizes = {s: pick.choice([0, 1, 50, 1000, 10**6]) + pick.randrange(50) * (k > 0) for s in ["", "a", "B", "é", "zz", None, *map(str, range(k * 7))]}
        found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        assert {r["source"]: r["target"] for r in found} == pytest.approx(targets_by_force(sizes))
    assert mixing.targets(spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")).agg({"target": "max"}).first()[0] == 0


def test_mix(spark, docs):
    rows = docs.collect()
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = Counter()
    for row in rows:
        sizes[row["source"]] += size(row["text"])
    aims = targets_by_force(sizes)
    found = mixing.plan(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in found) == Counter((r["doc_id"], r["source"], size(r["text"])) for r in rows)
    taken, largest = Counter(), Counter()
    for r in found:
        expected = aims[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["copies"] in (int(expected), -int(-expected // 1)) and r["copies"] <= 2
        assert r["target"] == pytest.approx(aims[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in sizes:
        assert abs(taken[source] - aims[source]) <= 1.5 * largest[source]
    again = mixing.plan(docs.repartition(3, "size")).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert Counter(map(tuple, mixing.plan(docs, seed="other").collect())) != Counter(map(tuple, found))


def test_mix_emits_each_row_as_often_as_planned(docs):
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(unique).collect()}
    mixed = mixing.mix(unique)
    assert mixed.columns == unique.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})


def test_places_do_not_depend_on_the_partitions(spark):
    rows = [(g, i, hashlib.md5(f"{g}{i}".encode()).hexdigest()) for g in ("a", None, "b") for i in range(150)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "g string, i long, h string").repartition(parts)
        found = {(r["g"], r["i"]): r["place"] for r in mixing.numbered(df, ["g"], ["h"]).collect()}
        for g in ("a", None, "b"):
            ordered = sorted((h, i) for own, i, h in rows if own == g)
            assert all(found[g, i] == k for k, (_, i) in enumerate(ordered, 1))


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert divergence.divergence(no_docs).count() == 0
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert mixing.plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
