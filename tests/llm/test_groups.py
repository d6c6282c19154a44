"""Operators across documents: lines, passages, near-duplicates, vectors, mixing, the pipeline."""

import collections
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from samples import awkward, frame, prose

import corpus_pipeline
from tallycast.llm import line_dedup, mixing, near_dedup, passages, queries, vector_dedup, words
from tallycast.llm.components import components


def components_of(nodes, links):
    parent = {node: node for node in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


@pytest.mark.parametrize("links", [
    [], [(5, 5), (None, 3)], [(n, n + 1) for n in range(60)], [(0, n) for n in range(1, 50)],
    [(random.Random(n).randrange(80), random.Random(n + 500).randrange(80)) for n in range(60)]])
def test_components(spark, links):
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = {node for link in real for node in link}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {row["node"]: row["component"] for row in got.collect()} == components_of(nodes, real)


def test_lines_of_later_windows_go(spark):
    a, b, c, d = "line a", "line b", "line c", "line d"
    rows = [(1, "\n".join([a, b, c])), (2, "\n".join(["x", a, b, c, d])), (3, "\n".join([a, b, "y", c])),
            (4, "\n".join([b, c, d, "z"])), (5, "\n".join([a] * 5)), *[row for row in awkward() if row[0] not in (1, 2, 3, 4, 5)]]
    got = line_dedup.dedup_lines(frame(spark, rows))
    texts = collections.defaultdict(list)
    for row in got.collect():
        texts[row["doc_id"]].append(row["text"])
    assert len(rows) == sum(map(len, texts.values()))
    assert texts[1] == ["\n".join([a, b, c])] and texts[2] == ["x\nline d"] and texts[3] == ["\n".join([a, b, "y", c])]
    assert texts[4] == ["z"] and texts[5] == [a]
    assert texts[10] == ["a\n\nb\n\n\n\n\n\n"]
    stage = corpus_pipeline.lines(spark, frame(spark, rows), "")
    assert stage.columns == frame(spark, []).columns
    assert all(row["n_chars"] == len(row["text"]) for row in stage.collect() if row["text"] is not None)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def changed(text, places):
    words = text.split()
    return " ".join(f"q{n}" if n in places else word for n, word in enumerate(words))


def near_rows():
    rows = [(1000 + n, prose(n, 100 + n)) for n in range(30)]
    rows += [(100 + n, changed(prose(1, 101), {5 * n + 3})) for n in range(19)]
    rows += [(200 + n, changed(prose(2, 102), {9, 20 + n, 60 + n})) for n in range(9)]
    # A chain: each differs a little from the one before.
    chain = prose(3, 103)
    for n in range(12):
        chain = changed(chain, {8 * n + 4})
        rows.append((300 + n, chain))
    return rows + [(400, prose(4, 104)), (401, prose(4, 104)), (402, "two words"), (403, "two words")]


def test_near_classes_equal_brute_force(spark):
    rows = near_rows() + awkward()
    docs = frame(spark, rows)
    weights = near_dedup.rarity(spark, docs)
    texts = {doc_id: text for doc_id, text, *_ in rows if doc_id is not None}
    ids = sorted(texts)
    values, counts, first = near_dedup.shingles_of(pa.array([texts[doc_id] for doc_id in ids], pa.string()))
    sets = [(values[a:b], counts[a:b]) for a, b in zip(first[:-1], first[1:])]
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i)
             if len(sets[i][0]) and near_dedup.similarity(sets[i], sets[j], weights) >= near_dedup.SIMILARITY]
    got = {row["doc_id"]: row["class_id"] for row in near_dedup.near_classes(docs).collect()}
    assert got == components_of(ids, links)
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    # A repeated row counts once; rows without an id stay.
    assert sorted(row["doc_id"] for row in kept.collect() if row["doc_id"] is not None) == sorted(
        doc_id for doc_id, of in got.items() if doc_id == of)
    assert kept.where("doc_id is null").count() == 2


def test_families_that_leaders_do_not_bridge_are_joined(spark, monkeypatch):
    base, places = prose(5, 200), {30, 90, 150}
    rows = [(1 + n, changed(base, {10 + 7 * n} if n else set())) for n in range(10)]
    rows += [(101 + n, changed(base, places | ({110 + 7 * n} if n else set()))) for n in range(5)]
    docs, texts = frame(spark, rows), dict(rows)
    weights, ids = near_dedup.rarity(spark, docs), sorted(texts)
    values, counts, first = near_dedup.shingles_of(pa.array([texts[doc_id] for doc_id in ids], pa.string()))
    sets = {doc_id: (values[a:b], counts[a:b]) for doc_id, a, b in zip(ids, first[:-1], first[1:])}
    alike = lambda a, b: near_dedup.similarity(sets[a], sets[b], weights)
    # Every text of the smaller family is closer to one of its own than to any of the larger.
    assert all(max(alike(x, y) for y in ids[10:] if y != x) > max(alike(x, y) for y in ids[:10]) for x in ids[10:])
    assert alike(101, 1) >= near_dedup.SIMILARITY
    own = [(a, b) for a in ids for b in ids if a < b and (a < 100) == (b < 100)]
    monkeypatch.setattr(near_dedup, "_paired_with_leaders", lambda *_: spark.createDataFrame(own, "a long, b long"))
    assert {row["class_id"] for row in near_dedup.near_classes(docs).collect()} == {1}


def test_near_classes_of_empty_tables(spark):
    assert near_dedup.near_classes(frame(spark, [])).count() == 0
    assert near_dedup.near_classes(frame(spark, [(1, None), (2, "")])).collect() == [] or all(
        row["kept"] for row in near_dedup.near_classes(frame(spark, [(1, None), (2, "")])).collect())


def test_sampling_agrees_with_similarity():
    draw = np.random.default_rng(0)
    shared, own = draw.integers(0, 1 << 62, 400, dtype=np.uint64), draw.integers(0, 1 << 62, 200, dtype=np.uint64)
    a, b = np.sort(np.concatenate([shared, own[:100]])), np.sort(np.concatenate([shared, own[100:]]))
    weight = lambda values: 1 + (values % np.uint64(3)).astype(float)
    drawn = near_dedup.samples_of(np.concatenate([a, b]), np.concatenate([weight(a), weight(b)]), np.array([0, 500, 1000]), 2000)
    true = weight(shared).sum() / (weight(a).sum() + weight(b).sum() - weight(shared).sum())
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(true, abs=0.05)


def test_passages_of_fifty_words_are_found(spark):
    passage, fuzzy = prose(77, 60), changed(prose(77, 60), {15, 31, 47})
    rows = [(1000 + n, prose(1000 + n, 150)) for n in range(20)]
    rows += [(50, f"{prose(50, 80)} {passage} {prose(51, 30)}"), (51, f"{prose(52, 10)} {passage}"),
             (52, f"{fuzzy} {prose(53, 200)}"), (53, f"{prose(54, 50)} {prose(78, 30)}"), (54, f"{prose(55, 50)} {prose(78, 30)}"),
             *[(60 + n, f"{prose(60 + n, 40)} {prose(79, 55)} {prose(90 + n, 40)}") for n in range(30)]]
    rows += [row for row in awkward() if row[0] is None or row[0] not in (1, 2, 3, 4)] + [(30, None), (31, ""), (32, "few words")]
    docs = frame(spark, rows)
    got = {row["doc_id"]: row for row in passages.passage_classes(docs).collect()}
    assert len(got) == len({row[0] for row in rows if row[0] is not None})
    assert {doc_id for doc_id in got if got[doc_id]["class_id"] == 50} == {50, 51, 52}
    assert {doc_id for doc_id in got if got[doc_id]["class_id"] == 60} == set(range(60, 90))
    assert all(got[n]["n_links"] == 0 and got[n]["class_id"] == n for n in (*range(1000, 1020), 53, 54, 30, 31, 32))
    text = dict(row[:2] for row in rows)
    start, end = map(int, got[51]["spans"].split(","[0])[0].split(":"))
    assert text[51][start:end] == passage
    assert passages.passage_classes(frame(spark, [])).count() == 0


def test_passages_are_found_whatever_earlier_documents_hold(spark):
    whole = [f"p{n}" for n in range(54)]
    own = lambda name: [f"{name}{n}" for n in range(20)]
    rows = [
        # The seeds of the passage occur first in documents that hold less of it.
        (1, own("a") + whole[:22] + own("b")), (2, own("c") + whole[16:40] + own("d")),
        (3, own("e") + whole[34:] + own("f")),
        (4, own("g") + whole + own("h")), (5, own("i") + whole + own("j")),
        # Runs of one word, the first of them shorter than a passage.
        (6, own("k") + ["la"] * 44 + own("l")), (7, own("m") + ["la"] * 90 + own("n")),
        (8, own("o") + ["la"] * 60 + own("p_")), (9, own("q") + ["la"] * 44 + own("r")),
    ]
    docs = frame(spark, [(n, " ".join(words)) for n, words in rows])
    got = {row["doc_id"]: row["class_id"] for row in passages.passage_classes(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9}


def test_passages_are_found_within_a_class(spark):
    own = lambda name: [f"{name}{n}" for n in range(20)]
    one, two = [f"p{n}" for n in range(60)], [f"q{n}" for n in range(54)]
    rows = [
        # The seeds of the second passage occur first in documents that hold less of it.
        (1, own("a") + two[:22] + own("b")), (2, own("c") + two[16:40] + own("d")), (3, own("e") + two[34:] + own("f")),
        (4, own("g") + one + own("h")),
        (5, own("i") + one + own("j") + two + own("k")), (6, own("l") + two + own("m") + one + own("n"))]
    text = {n: " ".join(words) for n, words in rows}
    got = {row["doc_id"]: row for row in passages.passage_classes(frame(spark, list(text.items()))).collect()}
    assert {n: got[n]["class_id"] for n in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4}
    assert [got[n]["n_links"] for n in (4, 5, 6)] == [2, 2, 2]
    for n in (5, 6):
        spans = [list(map(int, span.split(":"))) for span in got[n]["spans"].split(",")]
        assert {text[n][a:b] for a, b in spans} == {" ".join(one), " ".join(two)}


def test_fuzzy_passages_are_found_behind_partial_holders(spark):
    rows, pairs = [], 60
    for n in range(pairs):
        passage = [f"p{n}_{k}" for k in range(60)]
        # The first holder quotes 30 words; the others differ in so many of the rest that no seed is left there.
        edits = ({4, 14, 50}, {9, 45, 55})
        edited = [[f"e{n}_{side}_{k}" if k in edits[side] else word for k, word in enumerate(passage)] for side in (0, 1)]
        own = lambda name: [f"{name}{n}_{k}" for k in range(30)]  # noqa: E731, B023
        rows += [(n, " ".join(own("a") + passage[15:45] + own("b"))),
                 (100 + n, " ".join(own("c") + edited[0] + own("d"))), (200 + n, " ".join(own("e") + edited[1] + own("f")))]
    got = {row["doc_id"]: row["class_id"] for row in passages.passage_classes(frame(spark, rows)).collect()}
    assert all(got[n] == n for n in range(pairs))
    found = sum(got[200 + n] == 100 + n for n in range(pairs))
    assert found >= 0.5 * pairs


@pytest.mark.parametrize("exact, blocks", [(50, 2), (60, 3), (60, 9)])
def test_passages_next_to_templates_are_found(spark, exact, blocks):
    passage = [f"p{n}" for n in range(exact)]

    def record(name):
        return [word for n in range(blocks) for word in [f"{name}{n}_{k}" for k in range(8)] + [f"label{n}_{k}" for k in range(4)]]

    rows = [(1, record("a") + passage + record("b")), (2, record("c") + passage + record("d")), (3, record("e"))]
    text = {n: " ".join(words) for n, words in rows}
    got = {row["doc_id"]: row for row in passages.passage_classes(frame(spark, list(text.items()))).collect()}
    assert {n: (got[n]["class_id"], got[n]["n_links"]) for n in got} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    for n in (1, 2):
        start, end = map(int, got[n]["spans"].split(":"))
        assert " ".join(passage) in text[n][start:end]


def test_good_stretches_equal_brute_force():
    draw = random.Random(4)
    for _ in range(200):
        i, j, runs = 0, 0, []
        for _ in range(draw.randrange(1, 25)):
            runs.append((i, j, n := draw.choice([2, 4, 9, 30])))
            i, j = i + n + draw.randrange(9), j + n + draw.randrange(9)
        lengths = {}
        for p in range(len(runs)):
            for q in range(p, len(runs)):
                longer = max(runs[q][k] + runs[q][2] - runs[p][k] for k in (0, 1))
                if longer >= 50 and sum(n for *_, n in runs[p:q + 1]) >= 0.8 * longer:
                    lengths[p, q] = longer
        got = passages.good_stretches(runs, 50, 0.8)
        assert bool(got) == bool(lengths)
        if got:
            found = [max(b - a, d - c) for a, b, c, d, _ in got]
            assert found[0] == max(lengths.values())
            # Whatever is good touches a stretch that is reported.
            assert all(any(a < runs[q][0] + runs[q][2] and runs[p][0] < b for a, b, *_ in got) for p, q in lengths)


def test_longest_stretch_of_few_runs_equals_that_of_many():
    draw = random.Random(8)
    for _ in range(300):
        i, j, runs = 0, 0, []
        for _ in range(draw.randrange(1, 40)):
            runs.append((i, j, n := draw.choice([1, 4, 9, 30])))
            i, j = i + n + draw.randrange(9), j + n + draw.randrange(9)
        first, other, n = np.array(runs).T
        columns = first, first + n, other, other + n, np.append(0, np.cumsum(n))
        assert passages._longest_of_few(*[column.tolist() for column in columns], 50, 0.7) == passages._longest(*columns, 50, 0.7)


def test_words_around_seeds_equal_plain_definitions():
    draw = random.Random(7)
    texts = [" ".join(f"é{draw.randrange(9)}" for _ in range(draw.choice([0, 1, 5, 12, 40, 90]))) for _ in range(40)]
    found = words.words_of(pa.array([None, *texts, "x" * (words.BLOCK_BYTES + 9), ""]))
    mix = lambda value: int(words.mixed(np.array([value % 2**64], dtype=np.uint64))[0])
    polynomial = lambda values, base: sum(value * pow(base, k, 2**64) for k, value in enumerate(values))
    each = [text.split() for text in ["", *texts, "x" * (words.BLOCK_BYTES + 9), ""]]
    hashes = {word: mix(polynomial((byte + 1 for byte in word.encode()), int(words._BASE)))
              for word in {word for row in each for word in row}}
    assert found.hashes.tolist() == [hashes[word] for row in each for word in row]
    run = lambda row: mix(polynomial([hashes[word] for word in row], int(words._RUN_BASE)) + len(row))
    short = lambda key: int(np.array([key % 2**32], dtype=np.uint32).view(np.int32)[0])
    expected = []
    for number, row in enumerate(each):
        runs = [run(row[k:k + 8]) for k in range(len(row) - 7)]
        heads = range(max(len(runs) - 11, min(1, len(runs))))
        for k in sorted({min(range(h, min(h + 12, len(runs))), key=lambda place: (runs[place], place)) for h in heads}):
            def smallest(low, past):
                near = [run(row[p:p + 3]) for p in range(max(low, 0), past) if p + 3 <= len(row)]
                return short(mix(min(near))) if near else 0

            expected.append((number, runs[k], short(run(row[max(k - passages.BEFORE, 0):k + 8 + passages.AFTER])),
                             smallest(k - 20, k - 2), smallest(k + 8, k + 26)))
    hashes_of, first, rows = passages.chosen_runs(found)
    got = (rows, hashes_of, passages.surroundings(found, first, rows), *passages.smallest_near(found, first, rows))
    assert list(zip(*[column.tolist() for column in got])) == expected


def test_powers_are_made_once_for_all_blocks(monkeypatch):
    column = pa.array([prose(3000, 400), None, prose(3001, 90) + " é"])
    before = [part.tolist() for part in passages.seeds_of(column)]
    calls = []
    monkeypatch.setattr(words, "powers", lambda *given: calls.append(given))
    assert [part.tolist() for part in passages.seeds_of(column)] == before and not calls


def test_differences_equal_a_search_over_all_skips():
    draw = random.Random(6)
    for _ in range(400):
        x, y = (np.array([draw.randrange(3) for _ in range(draw.randrange(16))], dtype=np.uint64) for _ in "xy")
        expected = next(((i, j) for i, j in passages.SKIPS if len(x[i:i + 4]) == 4 == len(y[j:j + 4])
                         and (x[i:i + 4] == y[j:j + 4]).all()), None)
        assert passages._rejoined(x, y) == expected


def test_passages_keep_no_shuffle_files_and_move_common_seeds_only(spark):
    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for file in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in (name := file.rsplit("/", 1)[-1])}

    rows = [(n, f"{prose(2000 + n, 100)} {prose(2500 + n // 2, 60)}") for n in range(40)] + [(None, prose(2000, 100)), (50, None)]
    docs = frame(spark, rows).select("doc_id", "text").where("doc_id is not null")
    held = collections.defaultdict(set)
    for row in passages.seeds(docs).collect():
        held[row["seed"]].add(row["doc"])
    common = {(row["seed"], row["first_doc"]) for row in passages.common_seeds(docs).collect()}
    assert common == {(seed, min(of)) for seed, of in held.items() if len(of) > 1} and len(common) < len(held) / 2
    before = files()
    found = passages.passages(docs)
    for _ in range(50):
        if left := files() - before:
            time.sleep(0.2)
    assert not left
    assert {(row["first_doc"], row["doc"]) for row in found.collect()} >= {(n, n + 1) for n in range(0, 40, 2)}


def test_chains_equal_a_search_over_all_predecessors():
    draw = random.Random(5)
    for _ in range(60):
        count = draw.randrange(2, 25)
        a, b = (np.array([draw.randrange(200) for _ in range(count)]) for _ in "ab")
        size = np.array([draw.randrange(5, 30) for _ in range(count)])
        score = {}
        for i in sorted(range(count), key=lambda i: (a[i], b[i])):
            before = [score[j] - passages.GAP_COST * (a[i] - a[j] + b[i] - b[j]) for j in score if a[j] < a[i] and b[j] < b[i]]
            score[i] = size[i] + max([0.0, *before])
        best = passages.chains_of(a, b, size)[0]
        steps = np.diff(a[best]).sum() + np.diff(b[best]).sum()
        assert size[best].sum() - passages.GAP_COST * steps == pytest.approx(max(score.values()))


def vectors():
    draw = np.random.default_rng(1)
    rows, base = [], draw.normal(size=64)
    for n in range(120):
        rows.append((n, (base + 0.08 * draw.normal(size=64)).tolist(), 1))
    rows += [(200 + n, draw.normal(size=64).tolist(), n % 3) for n in range(60)]
    rows += [(300 + n, rows[0][1], 1) for n in range(40)] + [(350, rows[0][1], 2), (351, rows[0][1], None), (5, rows[5][1], 1)]
    return rows + [(400, None, 1), (401, [0.0] * 64, 1), (402, [float("nan")] * 64, 1), (403, [], 1), (404, [1.0, None], 1),
                   (405, [1.0, 2.0], 1), (406, [2.0, 4.0], 1), (407, [1e38, 2e38], 1), (None, rows[0][1], 1), (None, None, None)]


def test_vectors_equal_brute_force(spark, tmp_path):
    rows = vectors()
    schema = "vec_id long, embedding array<float>, label int, key string, copies string, a string"
    table = spark.createDataFrame([(*row, "x", "x", "x") for row in rows], schema)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    usable = {}
    for vec_id, values, label in rows:
        ok = vec_id is not None and label is not None and values and None not in values
        if ok and np.isfinite(values).all() and np.any(values):
            usable[vec_id] = (label, np.array(values, dtype=np.float32).astype(float))
    links = []
    for i in usable:
        for j in usable:
            if j < i and usable[i][0] == usable[j][0] and len(usable[i][1]) == len(usable[j][1]):
                x, y = usable[i][1], usable[j][1]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((i, j))
    degree = collections.Counter(end for link in links for end in link)
    of = components_of([row[0] for row in rows if row[0] is not None], links)
    got = queries.op9_cross_polytope(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for row in got:
        if row["vec_id"] is None:
            assert row["n_links"] == 0 and row["component_id"] is None and row["kept"]
        else:
            assert (row["n_links"], row["component_id"]) == (degree[row["vec_id"]], of[row["vec_id"]]), row
    assert vector_dedup.vector_classes(table.limit(0))[0].count() == 0


def test_permutations_hit_every_place_once():
    for count in (1, 2, 3, 17, 64, 1000):
        got = mixing.permuted(np.arange(count), np.full(count, count), np.full(count, 5, np.uint64))
        assert sorted(got.tolist()) == list(range(count))


def levelled(sizes, mix):
    """Targets by sharing the excess again and again."""
    names = sorted((name for name in sizes if name is not None)) + [None] * (None in sizes)
    weight = {name: mix.weights[n % len(mix.weights)] for n, name in enumerate(names)}
    target, left = {}, sum(sizes.values()) * mix.share
    free = list(names)
    while free:
        level = left / sum(weight[name] for name in free)
        full = [name for name in free if weight[name] * level > mix.most * sizes[name]]
        if not full:
            return target | {name: weight[name] * level for name in free}
        for name in full:
            target[name] = mix.most * sizes[name]
            left -= target[name]
            free.remove(name)
    return target


def test_mixture_meets_its_targets(spark):
    rows = [(n, prose(n, 30 + n % 400), "en", random.Random(n).choice(["a", "b", "b", "b", "c", "d", None])) for n in range(600)]
    rows += [(doc_id, text, "en", "z") for doc_id, text, *_ in awkward()]
    docs = frame(spark, rows)
    mix = mixing.Mix()
    got = mixing.mixed_documents(docs, mix).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for doc_id, text, _, source in rows:
        sizes[source] += len(re.findall("[^\x20\x09-\x0d]+", text or ""))
    target, taken = levelled(sizes, mix), collections.Counter()
    for row in got:
        assert row["taken"] <= 2 * row["size"] and row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        taken[row["source"]] += row["taken"]
    for source, words in target.items():
        assert taken[source] == pytest.approx(words, abs=max(2 * mix.block_words, 0.01 * words))
    again = mixing.mixed_documents(docs.repartition(7), mix).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_texts_hold_the_words_drawn(spark):
    rows = [(n, prose(n, 200), "en", f"s{n % 4}") for n in range(40)] + [(900, None), (901, ""), (None, prose(901, 70), "en", "s1")]
    docs = frame(spark, rows)
    plan = {row["doc_id"]: row["taken"] for row in mixing.mixed_documents(docs).collect()}
    got, words = mixing.mixed_texts(docs), collections.Counter()
    assert got.columns == docs.columns
    for row in got.collect():
        words[row["doc_id"]] += len(row["text"].split())
        assert row["n_chars"] == len(row["text"])
        whole = next(text for doc_id, text, *_ in rows if doc_id == row["doc_id"])
        assert set(row["text"].split()) <= set(whole.split())
    assert {doc_id: n for doc_id, n in plan.items() if n} == dict(words)
    assert mixing.mixed_texts(frame(spark, [])).count() == 0


def test_pipeline_stages_and_run(spark, tmp_path):
    rows = near_rows() + awkward()
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    step = docs
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        step = stage(spark, step, str(tmp_path))
        if place + 1 < len(corpus_pipeline.STAGES):
            assert step.columns == docs.columns
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, step.collect()))
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0
