"""Language identification, mixing, nearest neighbours and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import language_id, mixing, neighbours, substring_dedup
from tallyloom.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.conftest import CLASHES, DATA

QUICK = language_id.Settings(sample_rows=600, hidden=8, steps=80, batch=64)


def _held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def test_gradients_equal_differences():
    network = language_id.Network(4, ["a", "b", "c"], 1)
    network.weights = {name: weight.astype(np.float64) for name, weight in network.weights.items()}
    rng = np.random.default_rng(0)
    x = rng.integers(97, 110, (9, 6)).astype(np.uint8)
    labels = np.array([0, 1, 2, 0, 1, 2])
    _, found = network.gradients(x, labels)
    for name, weight in network.weights.items():
        for at in [tuple(rng.integers(0, n) for n in weight.shape) for _ in range(3)]:
            if name.endswith("_in"):
                at = (at[0], int(x[3, 2]))
            weight[at] += 1e-3
            above, _ = network.gradients(x, labels)
            weight[at] -= 2e-3
            below, _ = network.gradients(x, labels)
            weight[at] += 1e-3
            assert found[name][at] == pytest.approx((above - below) / 2e-3, abs=2e-4)


def test_probabilities_do_not_depend_on_the_neighbours():
    network = language_id.Network(8, ["a", "b"], 3)
    texts = [b"", b"x", b"some words " * 40, b"### 123", "é".encode() * 100]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = network.documents(data, offsets)
    for row, text in zip(together, texts):
        alone = network.documents(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert row == pytest.approx(alone, abs=1e-5)
    assert together[0].sum() == 0 and together[3].sum() == 0 and together[2].sum() == pytest.approx(1, abs=1e-4)


def test_language_query_is_right_on_held_out_documents(shipped, second):
    truth = dict(second.sql("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op9_language_id"](shipped, DATA).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == _held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_a_network_equals_a_plain_loop():
    """Every byte's probabilities by plain recurrent units, a segment at a time."""
    network = language_id.Network(3, ["a", "b", "c"], seed=4)
    texts = [b"", b"x", "Übung 12 macht den Meister, and so on; ".encode() * 4, b"123 .", b"y" * language_id.SEGMENT, b"z" * (language_id.SEGMENT + 1)]
    w = network.weights
    logistic = lambda v: 1 / (1 + np.exp(-v))

    def states(way, segment):
        h, out = np.zeros(3), {}
        for t in range(len(segment)) if way == "on" else reversed(range(len(segment))):
            own, old = w[f"{way}_in"][:, segment[t]].astype(float), w[f"{way}_again"].astype(float) @ h
            reset, update = logistic(own[:3] + old[:3]), logistic(own[3:6] + old[3:6])
            h = h + update * (np.tanh(own[6:] + reset * old[6:]) - h)
            out[t] = h
        return out

    wanted = []
    for text in texts:
        total, letters = np.zeros(3), 0
        for begin in range(0, len(text), language_id.SEGMENT):
            segment = text[begin : begin + language_id.SEGMENT].ljust(language_id.SEGMENT, b"\0")
            on, back = states("on", segment), states("back", segment)
            for t, byte in enumerate(segment):
                if chr(byte).isascii() and not chr(byte).isalpha():
                    continue
                logits = w["bias"][:, 0] + w["on_out"] @ on[t] + w["back_out"] @ back[t]
                total += np.exp(logits) / np.exp(logits).sum()
                letters += 1
        wanted.append(total / max(1, letters))
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    assert np.allclose(network.documents(data, offsets), wanted, atol=1e-5)


def test_all_segments_of_a_snippet_are_learned_from():
    texts = [b"", b"a" * 64, b"b" * 65, "é".encode() * 64]
    x, of = language_id.encode_segments(texts)
    assert of.tolist() == [0, 1, 2, 2, 3, 3]
    for i, text in enumerate(texts):
        assert b"".join(x[:, k].tobytes() for k in np.flatnonzero(of == i)).rstrip(b"\0") == text


def test_every_label_is_learned_or_refused(docs):
    rows = [(i, "some letters of it", f"l{i % 300}", "s") for i in range(900)]
    network = language_id.train_network(docs(*rows), language_id.Settings(hidden=2, steps=1, sample_rows=600))
    assert len(network.languages) == len({f"l{i % 300}" for i in range(900) if not _held_out(i)}) > 256
    with pytest.raises(ValueError, match="languages"):
        language_id.train_network(docs(*rows), language_id.Settings(hidden=2, steps=1, sample_rows=200))


def test_language_edge_cases_and_labels_that_are_not_read(docs):
    rng = random.Random(2)
    words = {"xx": ["alba", "corto", "mano"], "yy": ["stra", "wurk", "hund"]}
    rows = []
    for i in range(300):
        lang = ("xx", "yy")[i % 2]
        text = " ".join(rng.choice(words[lang]) for _ in range(20))
        label = lang if not _held_out(i) else ("yy", "xx")[i % 2]  # wrong labels where nothing may be learned
        rows.append((i, text, label, "s"))
    rows += [(1000, None, "xx", None), (1001, "", "yy", None), (1002, "123 ### !", "xx", None), (None, "alba corto", "yy", None),
             (1003, "alba mano " * 30_000, None, None), (1004, "hund", "yy", None), (1004, "hund", "yy", None)]
    table = docs(*rows)
    network = language_id.train_network(table, QUICK)
    assert network.languages == ["xx", "yy"]
    got = language_id.identify(table, network).collect()
    assert len(got) == len(rows)
    by_key = {r.doc_id: r for r in got}
    assert all(by_key[k].lang_pred == "und" and by_key[k].score == 0 for k in (1000, 1001, 1002))
    assert by_key[1003].lang_pred == "xx" and by_key[None].lang_pred == "xx"
    assert all(by_key[i].lang_pred == ("xx", "yy")[i % 2] for i in range(300))
    empty = table.limit(0)
    assert language_id.train_network(empty, QUICK) is None
    assert language_id.identify(empty, None).collect() == []
    assert {r.lang_pred for r in language_id.identify(table, None).collect()} == {"und"}
    sample = language_id.training_sample(table, language_id.Settings(sample_rows=50), "doc_id", "text", "lang")
    assert sorted(r["count"] for r in sample.groupBy("language").count().collect()) == [25, 25]


def _filled(shares, caps, whole):
    """Shares scaled by one factor, none beyond its cap, so that they add up to ``whole``; by bisection."""
    low, high = 0.0, 1e18
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(caps[k], level * s) for k, s in shares.items()) < whole else (low, level)
    return {k: min(caps[k], high * s) for k, s in shares.items()}


def _plain_raking(rows, target, sweeps=300):
    """Tokens and weights of cells by bounded proportional fitting, each category's factor found by bisection."""
    cells = {}
    for source, language, topic, tokens in rows:
        cells[source, language, topic] = cells.get((source, language, topic), 0) + tokens
    shares, caps = [], []
    for margin in range(3):
        own = {}
        for key, tokens in cells.items():
            own[key[margin]] = own.get(key[margin], 0) + tokens
        name = mixing.MARGINS[margin]
        given = target.shares.get(name) or {k: v ** target.temper[name] for k, v in own.items()}
        shares.append({k: given.get(k, 0.0) if v else 0.0 for k, v in own.items()})
        caps.append({k: v / target.budget for k, v in own.items()})
    most = [sum(cap for k, cap in own.items() if shares[i][k]) for i, own in enumerate(caps)]
    whole = min([*most, float(sum(cells.values()))])
    goals = [_filled(s, c, whole) for s, c in zip(shares, caps)]
    cap = {key: tokens / target.budget for key, tokens in cells.items()}
    free = {key: float(tokens) for key, tokens in cells.items()}
    for _ in range(sweeps):
        for margin in range(3):
            for category, goal in goals[margin].items():
                own = {key: w for key, w in free.items() if key[margin] == category}
                reach = sum(cap[key] for key, w in own.items() if w)
                low, high = 0.0, 1e6
                for _ in range(100 if goal < reach else 0):
                    middle = (low * high) ** 0.5 if low else high / 1e3
                    done = sum(min(cap[key], middle * w) for key, w in own.items()) < goal
                    low, high = (middle, high) if done else (low, middle)
                    if high < 1e-12:
                        high = 0.0
                        break
                for key in own:
                    free[key] *= high if goal < reach else 1.0
    return cells, {key: min(cap[key], w) for key, w in free.items()}, whole


@pytest.mark.parametrize(
    "target",
    [
        mixing.Target(),
        mixing.Target(shares={"language": {"en": 0.5, "fr": 0.5}, "topic": {"prose": 3, "table": 1, "no such": 9}}),
        mixing.Target(shares={"source": {"a": 0.2, "c": 0.8}}, budget=0.4, rounds=6),  # margins that contradict each other
    ],
)
def test_raking_equals_a_plain_version(shipped, target):
    rng = random.Random(5)
    rows = [
        (rng.choice("abbbbbc"), rng.choice(["en", "en", "fr"]), rng.choice(["prose", "prose", "table"]), rng.randrange(0, 50))
        for _ in range(400)
    ]
    measured = shipped.createDataFrame(rows, "source string, language string, topic string, tokens long")
    got = {tuple(r[:3]): r for r in mixing.raked_cells(measured, target).collect()}
    cells, weights, whole = _plain_raking(rows, target)
    assert {k: r.tokens for k, r in got.items()} == cells
    expected = sum(r.tokens * r.probability for r in got.values())
    if target.rounds == mixing.Target().rounds:
        for key, weight in weights.items():
            assert got[key].weight == pytest.approx(weight, rel=2e-3, abs=1e-4 * whole)
        assert expected == pytest.approx(target.budget * whole, rel=1e-3)
    assert expected <= target.budget * sum(cells.values()) * (1 + 1e-9)
    assert all(0 <= r.probability <= 1 for r in got.values())
    # What is drawn has the raked shares: nothing is cut afterwards.
    for place, margin in enumerate(mixing.MARGINS):
        for category in {key[place] for key in got}:
            own = [r for key, r in got.items() if key[place] == category]
            assert own[0][f"share_{margin}"] == pytest.approx(sum(r.tokens * r.probability for r in own) / expected, rel=1e-6)


def test_reachable_targets_are_met(shipped):
    """A source of few tokens is drawn whole; what it lacks goes to the others, and all margins hold."""
    rows = [(s, l, t, n) for s, n in (("tiny", 10), ("x", 500), ("y", 500)) for l in ("en", "fr") for t in ("prose", "table")]
    measured = shipped.createDataFrame(rows, "source string, language string, topic string, tokens long")
    target = mixing.Target(shares={"source": {"tiny": 0.5, "x": 0.3, "y": 0.2}, "language": {"en": 0.6, "fr": 0.4}})
    got = mixing.raked_cells(measured, target).collect()
    for r in got:
        for margin in mixing.MARGINS:
            assert r[f"share_{margin}"] == pytest.approx(r[f"target_{margin}"], abs=0.005)
    assert {r.source: round(r.target_source, 4) for r in got} == {"tiny": 0.0198, "x": 0.5881, "y": 0.3921}
    assert all(r.probability == pytest.approx(1) for r in got if r.source == "tiny")


def test_mixing_edge_cases(docs):
    rows = [(i, f"text {i} | table" if i % 3 else "plain words " * (i % 7), "en" if i % 2 else None, None if i % 5 else "s") for i in range(200)]
    rows += [(500, None), (501, ""), (None, "no key"), (502, "word " * 300_000, "fr", "t"), (7, "again", "en", "s")]
    plan = mixing.sampling_plan(docs(*rows)).collect()
    assert len(plan) == len(rows) and all(r.probability is not None and r.drawn is not None for r in plan)
    kept = mixing.mixed(docs(*rows))
    assert kept.columns == docs(*rows).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in plan if r.drawn)
    assert mixing.sampling_plan(docs(*rows).limit(0)).collect() == []
    assert mixing.mixed(docs(*rows).limit(0)).collect() == []


def test_mixing_query_meets_its_budget_without_python(shipped):
    df = QUERIES["op10_mixing"](shipped, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = df.collect()
    total = sum(r.tokens for r in got)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(0.5 * total, rel=0.01)
    assert 0.35 * total < sum(r.tokens for r in got if r.drawn) < 0.65 * total
    again = {r.doc_id for r in QUERIES["op10_mixing"](shipped, DATA).collect() if r.drawn}
    assert again == {r.doc_id for r in got if r.drawn}


def test_chi_square_quantiles():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)


def _nearest(vectors, queries, k):
    out = {}
    for own in queries:
        apart = sorted((float(np.sqrt(((v - vectors[own]) ** 2).sum())), key) for key, v in vectors.items() if key != own)
        out[own] = apart[:k]
    return out


def test_neighbour_recall_against_all_rows(shipped, second):
    vectors = {key: np.array(v, np.float32).astype(float) for key, v in second.sql("SELECT vec_id, embedding FROM embeddings").fetchall()}
    wanted = _nearest(vectors, [key for key in vectors if key % 100 == 0], 10)
    got = QUERIES["op7_neighbours"](shipped, DATA).collect()
    hits = 0
    for query, best in wanted.items():
        own = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {key for _, key in best})
    assert hits >= 0.95 * 10 * len(wanted)


def test_the_stop_spares_most_rows_where_vectors_cluster():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(50, 64))
    vectors = np.repeat(centres, 100, axis=0) + 0.1 * rng.normal(size=(5000, 64))
    tree = neighbours.ProjectedTree(np.arange(5000), vectors, neighbours.Settings())
    queries, hits = range(0, 5000, 100), 0
    wanted = _nearest(dict(enumerate(vectors)), queries, 10)
    for own in queries:
        ids, distances = tree.nearest(own, vectors[own], 10)
        assert sorted(zip(distances, ids)) == list(zip(distances, ids))
        hits += len({*ids.tolist()} & {key for _, key in wanted[own]})
    assert hits >= 0.95 * 10 * len(queries)
    assert tree.verified < 0.5 * 5000 * len(queries)


def test_a_row_is_shuffled_to_one_shard(shipped, monkeypatch):
    """The index is built once a shard, however many queries there are."""
    seen = []
    meet = neighbours.meet_in_cells

    def spy(held, sent, *rest):
        seen.append((held.count(), sent.count()))
        return meet(held, sent, *rest)

    monkeypatch.setattr(neighbours, "meet_in_cells", spy)
    rows = shipped.range(400).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    rows = shipped.createDataFrame(rows.collect(), rows.schema)
    found = neighbours.nearest_neighbours(rows, F.lit(True), k=3, settings=neighbours.Settings(shard_rows=100))
    assert seen == [(400, 4 * 400)] and found.count() == 3 * 400


def test_neighbours_of_many_copies_odd_vectors_and_shards(shipped):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]  # a third and more are one vector
    rows += [(1000 + i, rng.normal(size=3).tolist()) for i in range(200)]
    odd = [(5000, None), (5100, []), (5200, [0.0, 0.0, 0.0]), (5300, [1.0, None, 2.0]), (5400, [float("nan"), 1.0, 1.0]),
           (5500, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (6000, [1.0, 2.0]), (6001, [1.0, 2.5])]
    frame = shipped.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(4)
    frame = frame.withColumns({"id": F.lit(1), "vector": F.lit("v"), "size": F.lit(2), "shard": F.lit(3), "score": F.lit(4)})
    small = neighbours.Settings(shard_rows=100, leaf=8, confidence=0.999)
    got = neighbours.nearest_neighbours(frame, F.col("vec_id") % 100 == 0, settings=small).collect()
    vectors = {key: np.array(v, np.float32).astype(float) for key, v in rows}
    wanted = _nearest(vectors, [key for key in vectors if key % 100 == 0], 10)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(found) == {*wanted, 6000}
    assert found[6000] == [(0.5, 6001)]
    hits = sum(len(set(found[q]) & set(best)) for q, best in wanted.items())
    assert hits >= 0.97 * sum(map(len, wanted.values()))
    assert all(found[q] == wanted[q] for q in (0, 100, 200))  # ties go to the smallest keys
    none = neighbours.nearest_neighbours(frame.limit(0), F.col("vec_id") % 100 == 0, settings=small)
    assert none.collect() == []


def test_pipeline_stages_one_by_one(shipped, docs, stored):
    shipped_docs = shipped.read.parquet(f"{DATA}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "mixing", "byte_bpe"]
    stages = dict(corpus_pipeline.STAGES)
    junk = shipped.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 456", "en", "s", 7)], shipped_docs.schema)
    known = stages["language_id"](shipped, shipped_docs.union(junk), DATA)
    kept = {r.doc_id for r in known.collect()}
    assert not {10**6, 10**6 + 1} & kept and len(kept) >= 0.99 * len(stored)
    near = stages["near_dedup"](shipped, shipped_docs, DATA)
    wanted = {key for key, (_, _, first) in plain.near_duplicates(stored.items(), 5, 80).items() if first}
    assert {r.doc_id for r in near.collect()} == wanted
    cut = {r.doc_id: (r.text, r.n_chars) for r in stages["substring_dedup"](shipped, near, DATA).collect()}
    texts = plain.without_repeats([(key, stored[key]) for key in wanted])
    assert cut == {key: (text, len(text)) for key, (text, _, gone) in texts.items() if not gone or text.strip()}
    mixed = stages["mixing"](shipped, shipped_docs, DATA)
    drawn = {r.doc_id for r in mixing.sampling_plan(shipped_docs).collect() if r.drawn}
    assert {r.doc_id for r in mixed.collect()} == drawn
    for frame in (known, near, mixed):
        assert frame.columns == shipped_docs.columns


def _awkward(shipped, rows):
    """Documents with columns of clashing names, each with a value of its own."""
    frame = shipped.createDataFrame(rows, shipped.read.parquet(f"{DATA}/documents.parquet").schema).repartition(3)
    return frame.withColumns({name: F.lit(value) for name, value in CLASHES.items()})


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_keep_columns_of_any_name(shipped, second, name):
    stored = second.sql("SELECT * FROM documents ORDER BY doc_id LIMIT 120").fetchall()
    rows = [tuple(r) for r in stored] + [tuple(stored[0]), (5_000, None, None, None, None), (5_001, "", "en", "s", 0), (None, "no key at all", "en", "s", 13)]
    docs = _awkward(shipped, rows)
    out = dict(corpus_pipeline.STAGES)[name](shipped, docs, DATA)
    found = out.collect()
    assert found
    if name != "byte_bpe":
        assert out.columns == docs.columns
        assert all(r[c] == v for r in found for c, v in CLASHES.items())


def test_pipeline_keeps_one_of_repeated_rows(shipped):
    text = "a document that stands in the table more than once, word for word"
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (1, text.upper(), "en", "t", 9), (2, text, "en", "s", 9), (3, "another text that is like no other one", "en", "s", 9),
            (3, "and a second version of it under the very same key", "en", "s", 9), (4, None, "en", "s", 0), (4, None, "en", "s", 0)]
    docs = shipped.createDataFrame(rows, shipped.read.parquet(f"{DATA}/documents.parquet").schema).repartition(3)
    got = corpus_pipeline.drop_near_duplicates(shipped, docs, DATA).collect()
    assert sorted((r.doc_id, r.text or "", r.source) for r in got) == sorted(
        [(1, text.upper(), "t"), (3, rows[4][1], "s"), (3, rows[5][1], "s"), (4, "", "s")]
    )


def test_pipeline_runs_whole_and_on_nothing(shipped, tmp_path):
    rows = corpus_pipeline.run(shipped, DATA).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    empty = shipped.read.parquet(f"{DATA}/documents.parquet").limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(shipped, str(tmp_path)).collect() == []
    assert substring_dedup.remove_repeats(empty).collect() == []
