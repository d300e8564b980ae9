"""PartEnum join, components and repeated strings against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from paneltide.llm import components, partenum_join, run_length_index
from tests.llm.conftest import edge_rows, prose


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k: k + width]) for k in range(len(words) - width + 1)}


def brute(rows, percent, width):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    return sorted((str(d), len(sets[k]), str(least.get(find(k)) if sets[k] else d)) for k, (d, _) in enumerate(rows))


def family(seed, words, copies, edits):
    """A text and copies with a few words changed."""
    r = random.Random(seed)
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for c in range(copies):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"x{r.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def linked(sets, percent):
    """Component labels by all pairs."""
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(np.intersect1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both) and label[i] != label[j]:
                label = [label[i] if v == label[j] else v for v in label]
    return label


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_star_links_against_all_pairs(percent):
    rng = np.random.default_rng(percent)
    for _ in range(60):
        bases = [rng.choice(400, rng.integers(1, 60), replace=False) for _ in range(rng.integers(1, 5))]
        sets = []
        for _ in range(rng.integers(1, 40)):
            s = set(bases[rng.integers(len(bases))].tolist())
            for _ in range(rng.integers(0, 9)):
                if len(s) > 1 and rng.random() < 0.5:
                    s.discard(int(rng.choice(list(s))))
                else:
                    s.add(int(rng.integers(400)))
            sets.append(np.array(sorted(s), np.uint64))
        pivot = sets[rng.integers(len(sets))]
        links = partenum_join.star_links(np.arange(len(sets)), np.array([len(s) for s in sets]), [np.setxor1d(s, pivot) for s in sets], percent)
        label = list(range(len(sets)))
        for a, b in links:
            assert label[a] != label[b]  # a forest
            label = [label[a] if v == label[b] else v for v in label]
        expected = linked(sets, percent)
        assert len(set(zip(label, expected))) == len(set(label)) == len(set(expected))


@pytest.mark.parametrize("percent,width,block,size", [(85, 4, 4096, 1 << 24), (80, 5, 4096, 1 << 24), (85, 4, 7, 1 << 24), (85, 4, 4096, 20_000)])
def test_join_against_brute_force(spark, monkeypatch, percent, width, block, size):
    monkeypatch.setattr(partenum_join, "BLOCK", block)
    monkeypatch.setattr(partenum_join, "BLOCK_BYTES", size)
    r = random.Random(percent)
    texts = []
    for seed, (words, copies, edits) in enumerate([(5, 4, 1), (12, 6, 1), (40, 10, 2), (150, 40, 6), (400, 25, 16), (1500, 6, 60), (9, 5, 1), (70, 30, 4)]):
        texts += family(seed, words, copies, edits)
    chain = prose(77, 200).split()
    for k in range(12):  # each links with the next, the ends do not
        texts.append(" ".join(chain[3 * k: 3 * k + 150]))
    texts += [prose(1000 + k, r.randint(1, 60)) for k in range(80)] + ["", None, "one", "ONE", "one two", "a b c d", "A  B\tc d"]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, label string, sig int").repartition(5)
    got = partenum_join.joined(docs, percent, width).collect()
    assert sorted((str(g["doc_id"]), g["n_shingles"], str(g["component_id"])) for g in got) == brute(rows, percent, width)


def test_edge_rows(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = partenum_join.joined(edge, 85).collect()
    assert sorted((str(g["doc_id"]), g["n_shingles"], str(g["component_id"])) for g in got) == brute(rows, 85, 4)
    kept = partenum_join.one_of_each(edge, 85, 4)
    assert kept.columns == edge.columns
    ids = [k["doc_id"] for k in kept.collect()]
    assert ids.count(6) == 1 and ids.count(12) == 1 and 4 not in ids and 5 not in ids and {0, 1, 2, 3} <= set(ids)
    assert partenum_join.joined(empty, 85).count() == 0 and partenum_join.one_of_each(empty, 85, 4).count() == 0


def test_sets_that_only_null_ids_hold(spark):
    """Such sets link as members and as pivots of their stars."""
    w = prose(55, 200).split()
    bridge = [" ".join(w[k: k + 150]) for k in (0, 10, 20)]  # the middle links with both, the ends do not
    rows = [(20, bridge[0]), (None, bridge[1]), (21, bridge[2])]
    rows += [(None if k % 3 else 30 + k, t) for k, t in enumerate(family(56, 90, 9, 1))]
    rows += [(None, t) for t in dict.fromkeys(family(57, 60, 9, 1))]  # a class without any id
    rows += [(50, t) for t in dict.fromkeys(family(58, 60, 9, 1))] + [(None, ""), (None, None), (60, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = partenum_join.joined(docs, 85).collect()
    assert sorted((str(g["doc_id"]), g["n_shingles"], str(g["component_id"])) for g in got) == brute(rows, 85, 4)
    for first in (7, None):  # one of the two is its star's pivot
        pair = [(first, bridge[0]), (None, bridge[1])]
        got = partenum_join.joined(spark.createDataFrame(pair, "doc_id long, text string"), 85).collect()
        assert sorted((str(g["doc_id"]), g["n_shingles"], str(g["component_id"])) for g in got) == brute(pair, 85, 4)
    kept = sorted((str(k["doc_id"]), k["text"] or "") for k in partenum_join.one_of_each(docs, 85, 4).collect())
    assert [k for k, t in kept if t] == ["20", "30", "50", "None"]
    assert [k for k, t in kept if not t] == ["60", "None", "None"]


def test_linked_sets_share_a_signature():
    """Sets at the very edge of the threshold, of many sizes."""
    r = np.random.default_rng(3)
    for percent in (80, 85):
        for n in (*range(1, 60), 80, 130, 333, 1000):
            for _ in range(3):
                a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
                d = len(a) * (100 - percent) // 100  # drop these: still linked
                b = np.sort(r.permutation(a)[d:])
                e = int(2 * len(a) * (100 - percent) / (100 + percent)) // 2  # replace these: still linked
                c = np.unique(np.concatenate([r.permutation(a)[e:], r.integers(0, 1 << 63, e, dtype=np.uint64)]))
                for other in (b, c):
                    both = len(np.intersect1d(a, other))
                    if not len(other) or 100 * both < percent * (len(a) + len(other) - both):
                        continue
                    num, sig = partenum_join.signatures([a, other], percent)
                    assert set(sig[num == 0].tolist()) & set(sig[num == 1].tolist()), (percent, n)


def test_linked_sets_share_as_many_signatures_as_they_need():
    r = np.random.default_rng(4)
    for percent in (80, 85):
        for n in (3, 8, 20, 45, 60, 90, 150, 333, 1000):
            for _ in range(6):
                a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
                e = int(2 * len(a) * (100 - percent) / (100 + percent)) // 2
                for other in (np.sort(r.permutation(a)[len(a) * (100 - percent) // 100:]),
                              np.unique(np.concatenate([r.permutation(a)[e:], r.integers(0, 1 << 63, e, dtype=np.uint64)]))):
                    both = len(np.intersect1d(a, other))
                    if not len(other) or 100 * both < percent * (len(a) + len(other) - both):
                        continue
                    num, sig, need = partenum_join.signed([a, other], percent)
                    assert len(set(sig[num == 0].tolist()) & set(sig[num == 1].tolist())) >= need.max(), (percent, n)
        _, _, need = partenum_join.signed([np.unique(r.integers(0, 1 << 63, 500, dtype=np.uint64)) for _ in range(50)], percent)
        assert np.median(need) > 3  # what sets share by chance doesn't do


def test_packed_signatures_make_groups(monkeypatch):
    r = np.random.default_rng(5)
    for chunk in (1, 50, 333, 500_000):
        monkeypatch.setattr(partenum_join, "ENTRIES", chunk)
        pool = r.integers(0, 1 << 63, 90, dtype=np.uint64) * np.uint64(2)
        sigs, ids = pool[r.integers(0, 90, 400)], r.integers(-30, 30, 400)
        members = {}
        for s, i in zip(sigs.tolist(), ids.tolist()):
            members.setdefault(s, set()).add(i)
        expected = {}
        for m in members.values():
            if len(m) > 1:
                expected[frozenset(m)] = expected.get(frozenset(m), 0) + 1
        packed = [partenum_join._packed(sigs[k: k + 100], ids[k: k + 100], ids[k: k + 100] + 300 * (ids[k: k + 100] > 20) + 40) for k in range(0, 400, 100)]
        rows = pa.Table.from_batches(packed).sort_by("bucket").combine_chunks()
        assert sum(len(x.as_py()) for x in rows["entries"]) == 400 * partenum_join.ENTRY
        got = {}
        for batch in partenum_join._met(rows.to_batches(max_chunksize=7)):
            for g, i, weight, need in zip(*(c.to_pylist() for c in batch.columns)):
                assert need == (255 if i > 20 else i + 40)
                got.setdefault(g, {}).setdefault(i, []).append(weight)
        assert {frozenset(m): sum(next(iter(m.values()))) for m in got.values()} == expected


def test_sets_that_share_common_words_only_meet_nobody(spark, monkeypatch):
    """Of 120 texts with the same sentence, nearly all share signatures by
    chance; only the copies among them travel to a star."""
    r = random.Random(8)
    line = prose(500, 12)
    texts = []
    for k in range(120):
        w = [f"w{r.randrange(10 ** 9)}" for _ in range(200)]
        texts.append(" ".join(w + [line]))
    w = texts[0].split()
    texts += [" ".join([*w[:30], f"y{k}", *w[31:]]) for k in range(3)]
    rows = list(enumerate(texts))
    seen = []

    def links(members, *rest, plain=partenum_join._links):
        seen.append(members.filter("member = 1").select("set_id").distinct().count())
        return plain(members, *rest)

    monkeypatch.setattr(partenum_join, "_links", links)
    got = partenum_join.joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 80, 5).collect()
    assert sorted((str(g["doc_id"]), g["n_shingles"], str(g["component_id"])) for g in got) == brute(rows, 80, 5)
    assert 4 <= seen[0] <= 8


def test_components(spark):
    r = random.Random(0)
    links = [(k, k + 1) for k in range(0, 60)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(50)] + [(500, 500 + k) for k in range(1, 40)]
    got = {x["node"]: x["label"] for x in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {x: got.get(x, x) for x in parent} == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def removed_brute(rows, length):
    seen, out = set(), []
    for d, t in rows:
        data = (t or "").encode()
        hit = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            w = data[k: k + length]
            if w in seen:
                hit[k: k + length] = True
            seen.add(w)
        runs = int((hit & ~np.concatenate([[False], hit[:-1]])).sum()) if len(hit) else 0
        out.append((d, len(data), int(hit.sum()), runs, np.frombuffer(data, np.uint8)[~hit].tobytes()))
    return out


def test_index_against_search():
    r = random.Random(3)
    for _ in range(25):
        strings = ["".join(r.choice("ab") for _ in range(r.randint(0, 60))).encode() for _ in range(r.randint(1, 8))]
        index, text = run_length_index.RunLengthIndex(strings, 5), b"\0".join(strings) + b"\0"
        for p in (b"a", b"ab", b"abba", b"bbbbb", b"aababb", b"c"):
            n = sum(s[i:].startswith(p) for s in strings for i in range(len(s)))
            at = index.locate(p)
            assert index.count(p) == n and (text[at: at + len(p)] == p if n else at == -1)
        origin, seen = np.cumsum([0, *(len(s) + 5 for s in strings)])[:-1], set()
        for s, found in zip(strings, run_length_index.earlier_matches(strings, origin, 5)):
            want = []
            for k in range(len(s) - 4):
                if s[k: k + 5] in seen:
                    want.append(k)
                seen.add(s[k: k + 5])
            assert found.tolist() == want


def test_index_sorts_numbers_and_streams_without_searches(monkeypatch):
    """Keys that fit into a number with their place are sorted as one, and the
    stream looks no row's run up by a search."""
    r = np.random.default_rng(5)
    for place in (10, 40):
        key = r.integers(0, 1 << 30, 1000) // 7 % 50 << 20
        order, s = run_length_index._sorted(key, place)
        assert order.tolist() == np.argsort(key, kind="stable").tolist() and (s == key[order]).all()
    strings = [bytes(r.integers(0, top, n, np.uint8)) for top, n in ((256, 300), (3, 90), (2, 160), (1, 160), (256, 0))] * 2
    origin = np.cumsum([0, *(len(s) + 100 for s in strings)])[:-1]
    monkeypatch.setattr(run_length_index.RunLengthIndex, "step", None)
    found = run_length_index.earlier_matches(strings, origin, 20)
    seen = set()
    for s, at in zip(strings, found):
        want = []
        for k in range(len(s) - 19):
            if s[k: k + 20] in seen:
                want.append(k)
            seen.add(s[k: k + 20])
        assert at.tolist() == want


def corpus():
    r = random.Random(8)
    passages = [prose(200 + k, 40) for k in range(4)]
    texts = [" ".join(prose(r.randint(0, 10 ** 6), r.randint(0, 60)) if r.random() < 0.6 else r.choice(passages) for _ in range(r.randint(1, 5))) for _ in range(60)]
    texts += family(5, 120, 12, 4) + ["é" * 300, "a" * 1000, "ab" * 400, "a" * 99, "a" * 100, "", None, texts[0], texts[0]]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot,piece", [(20_000, 1_000_000), (3, 700)])
def test_repeats_against_brute_force(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(run_length_index, "HOT", hot)
    monkeypatch.setattr(run_length_index, "SLICE", piece)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, start int, doc int").repartition(4)
    got = run_length_index.removed(docs, 100).collect()
    assert sorted((g["doc_id"], g["n_bytes"], g["n_removed"], g["n_spans"], bytes(g["kept"])) for g in got) == removed_brute(rows, 100)


def test_repeats_pieces_of_long_texts(monkeypatch):
    texts = [prose(k, 300).encode() for k in range(3)] + [b"z" * 500, b"y" * 99]
    whole = run_length_index.occurrences(texts, 100)
    monkeypatch.setattr(run_length_index, "SLICE", 150)
    cut = run_length_index.occurrences(texts, 100)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_repeats_edge_rows(spark, edge, empty):
    got = run_length_index.removed(edge, 100).collect()
    assert len(got) == len(edge_rows()) and run_length_index.removed(empty, 100).count() == 0
    by = {g["doc_id"]: g for g in got if g["doc_id"] not in (None, 6, 12)}
    assert by[0]["n_removed"] == 0 and by[4]["n_removed"] == by[4]["n_bytes"] and by[10]["n_removed"] == 699
    assert by[9]["n_removed"] > 100 and by[1]["n_bytes"] == 0
    for g in got:
        assert g["n_bytes"] - g["n_removed"] == len(g["kept"]) and len(g["runs"]) == g["n_spans"]
