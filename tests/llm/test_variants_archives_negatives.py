"""Spelling variants, packed web archives and hard negatives."""

import gzip
import hashlib
import io
import math
import random
import zipfile
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives, spelling, warc
from tallyloom.llm.zip_directory import members, stored_range
from tallyloom.operators.hot_join import LEAST_ROWS
from tallyloom.sinks.scratch import materialize, new_scratch_path
from tests.llm.conftest import CLASHES


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _variants(counts, least_count=2, ratio=10):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    words = {w: n for w, n in counts.items() if n >= least_count}
    near = {w: [x for x in words if _one_edit(w, x)] for w in words}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * words[word]:
            forms[word] = best

    def root(word):
        return root(forms[word]) if word in forms else word

    return {w: (forms.get(w), root(w), n, len(near[w]), words.get(forms.get(w))) for w, n in words.items()}


def _grouped(frame, **options):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(frame, **options).collect()}


@pytest.mark.parametrize("alphabet", ["ab", "abé", "aÿ\U0010ffff"])
def test_a_list_walk_finds_the_words_of_its_half(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(40):
        words = list({"".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(60)})
        walked = spelling.SortedList(words, [1] * len(words))
        got = sorted((words[a], walked.words[b]) for a, b in zip(*walked.one_edit_apart(words)))
        assert got == sorted((a, b) for a, b in product(words, words) if _one_edit(a, b) and b.startswith(a[: len(a) // 2]))


@pytest.mark.parametrize("block_words", [40, 40_000])
def test_variants_equal_all_pairs(shipped, block_words):
    """Words of which a third begin alike, so that one range lies over many blocks."""
    rng = random.Random(3)
    counts = {"": 4, "a": 50, "ab": 3, "x" * 3_000: 9, "x" * 2_999 + "y": 100}
    for _ in range(600):
        head = "prefix" if rng.random() < 0.4 else "".join(rng.choice("abcd") for _ in range(3))
        counts[head + "".join(rng.choice("abé") for _ in range(rng.randrange(1, 6)))] = rng.choice([1, 2, 2, 3, 25, 40, 400, 5_000])
    rows = [(w, n) for w, n in counts.items()] + [(None, 9), ("prefixa", 1)]
    counts["prefixa"] = counts.get("prefixa", 0) + 1
    frame = shipped.createDataFrame(rows, "word string, n long").withColumns({k: F.lit(v) for k, v in CLASHES.items()})
    settings = spelling.Settings(block_words=block_words, batch_words=64)
    wanted = _variants(counts)
    assert _grouped(frame, settings=settings) == wanted
    assert any(root != form for form, root, *_ in wanted.values() if form)


def test_forms_are_followed_through_long_chains(shipped):
    """Each word is ten times rarer than the next, one letter away."""
    base = "abcdefghijkl"
    words = [base[:i] + "z" * i + base[i:] for i in range(8)]
    rows = [(word, 2 * 10 ** (7 - i)) for i, word in enumerate(words)]
    got = _grouped(shipped.createDataFrame(rows, "word string, n long"))
    assert got == _variants(dict(rows)) and set(got) == set(words)


def test_words_of_documents(docs):
    long = "Überlänge " * 100_000
    rows = [(1, "Hello WORLDWIDE worldwide×x ÀÉÎÕÜÝÞ àéîõüýþ"), (1, "worldwide"), (2, None), (3, ""), (None, "worldwide"), (4, long),
            (5, "abcdefg1abcdefgh_ABCDEFGH ŁABCDEFGH")]

    def counted(misspell):
        found = spelling.count_words(docs(*rows), misspell=misspell).groupBy("word").agg(F.sum("n").alias("n"))
        return {r.word: r.n for r in found.collect()}

    assert counted(None) == {"worldwide": 3, "worldwide×x": 1, "ÀÉÎÕÜÝÞ": 1, "àéîõüýþ": 1, "Überlänge": 100_000, "abcdefg": 1, "abcdefgh": 3}
    wanted = Counter()
    for key, word, n in [(1, "worldwide", 2), (None, "worldwide", 1), (1, "worldwide×x", 1), (1, "ÀÉÎÕÜÝÞ", 1), (1, "àéîõüýþ", 1),
                         (4, "Überlänge", 100_000), (5, "abcdefg", 1), (5, "abcdefgh", 3)]:
        drawn = crc32(f"{'' if key is None else key}:{word}".encode())
        spelt = word if drawn % 2 else word[: drawn % len(word)] + word[drawn % len(word) + 1 :]
        wanted[spelt] += n if len(spelt) >= 7 else 0
    assert counted(2) == {w: n for w, n in wanted.items() if n}
    empty = spelling.group_variants(spelling.count_words(docs((1, "x")).limit(0)))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


PAGE = "page_id long, url string, html string"


def _records(pages, **options):
    packages = materialize(warc.write_packages(pages, new_scratch_path(pages.sparkSession, "packages"), **options), "packages")
    return packages, warc.read_packages(packages, with_payload=True)


@pytest.mark.parametrize("hot_rows", [2, LEAST_ROWS])
def test_archives_come_back_whole(shipped, hot_rows):
    long = "é" * 3_000_000
    rows = [(1, "http://a.org/x", "same"), (9, "http://a.org/y", "same"), (4, None, "same"), (None, "u", "same"), (2, "http://b\r\nX: y", "é\x00\r\n\r\nWARC/1.1"),
            (3, "", None), (5, "http://c", ""), (6, "http://d", long), (7, "http://e", "same "), (9, "http://a.org/y", "same")]
    pages = shipped.createDataFrame(rows, PAGE).repartition(3).withColumns({k: F.lit(v) for k, v in {**CLASHES, "key": 1, "sum": "s", "payload": b"p"}.items()})
    packages, records = _records(pages, hot_rows=hot_rows, package_bytes=1_000)
    assert packages.agg(F.sum("records")).first()[0] == len(rows)
    got = records.collect()
    texts = [(key, (html or "").encode()) for key, _, html in rows]
    keepers = {payload: max((k for k, p in texts if p == payload and k is not None)) for _, payload in texts}
    wanted = []
    for (key, payload), (_, url, _) in zip(texts, rows):
        revisit = key != keepers[payload]
        wanted.append((
            f"urn:page:{'' if key is None else key}", "revisit" if revisit else "response",
            None if url is None else url.replace("\r\n", "%0D%0A"), len(payload), warc.payload_digest(payload),
            f"urn:page:{keepers[payload]}" if revisit else None, None if revisit else payload,
        ))
    clear = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(clear, key=repr) == sorted(wanted, key=repr)


def test_small_payloads_are_never_revisits(shipped):
    pages = shipped.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (None, "u", "abcd"), (None, "u", "abcd")], PAGE)
    got = sorted((r.record_id, r.record_type) for r in _records(pages, least_bytes=3)[1].collect())
    assert got == [("urn:page:", "response")] * 2 + [("urn:page:1", "response"), ("urn:page:2", "response"), ("urn:page:3", "revisit"), ("urn:page:4", "response")]
    packages, records = _records(pages.limit(0))
    assert packages.collect() == records.collect() == []


def _packed(path, parts, compression=zipfile.ZIP_STORED, comment=b""):
    with zipfile.ZipFile(path, "w", compression) as out:
        out.comment = comment
        for name, data in parts.items():
            out.writestr(name, data)


def _reader(data):
    return lambda offset, length: data[offset : offset + length]


@pytest.mark.parametrize("wide", [False, True])
def test_directories_of_either_kind(monkeypatch, wide):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 8)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    parts = {f"{i}é.txt" if i % 2 else f"{i}.txt": bytes([i]) * i * 7 for i in range(20)}
    sink = io.BytesIO()
    _packed(sink, parts, comment=b"a comment with PK\5\6 inside, and some more text")
    data = sink.getvalue()
    assert (b"PK\6\6" in data) == wide
    found = members(_reader(data), len(data))
    assert [m.name for m in found] == list(parts)
    for member in found:
        start, length = stored_range(_reader(data), member)
        assert data[start : start + length] == parts[member.name]
    for damaged in (b"", data[:50], data[: len(data) // 2]):
        with pytest.raises(ValueError):
            members(_reader(damaged), len(damaged))


def test_packages_of_others(shipped, tmp_path, monkeypatch):
    """Records in another order and file, ZIP64 places, several archives; no index, compressed and damaged ones."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    one, two = (gzip.compress(warc.record_bytes(k, "http://x", b"payload %d" % k, None)) for k in (1, 2))
    line = 'x)/ 2000 {{"url": "http://x", "filename": "{}", "offset": "{}", "length": {}}}\n'
    index = line.format("archive/b.warc.gz", 0, len(two)) + line.format("archive/a.warc.gz", len(two), len(one))
    parts = {"archive/a.warc.gz": two + one, "archive/b.warc.gz": two, "indexes/index.cdxj": index}
    _packed(tmp_path / "good.wacz", parts)
    _packed(tmp_path / "bare.wacz", {"archive/a.warc.gz": one})
    _packed(tmp_path / "deflated.wacz", parts, zipfile.ZIP_DEFLATED)
    wrong = gzip.compress(warc.record_bytes(1, "http://x", b"payload", None).replace(b"payload\r\n", b"peyload\r\n"))
    _packed(tmp_path / "wrong.wacz", {"archive/a.warc.gz": wrong, "indexes/index.cdxj": line.format("archive/a.warc.gz", 0, len(wrong))})

    def read(*names):
        rows = [(str(tmp_path / name), (tmp_path / name).stat().st_size) for name in names]
        return warc.read_packages(shipped.createDataFrame(rows, "path string, bytes long"), with_payload=True).collect()

    assert sorted(bytes(r.payload) for r in read("good.wacz", "bare.wacz")) == [b"payload 1", b"payload 2"]
    for name, said in (("deflated.wacz", "compressed"), ("wrong.wacz", "digest")):
        with pytest.raises(Exception, match=said):
            read(name)


VECTORS = "vec_id long, embedding array<double>, label int"


def _negatives(rows, scale=256, positives=5, negatives=10, window=(30, 90)):
    """Sorted result rows by comparing all pairs; rows must not repeat."""
    usable = [
        (key, [math.floor(scale * x) for x in vector], label)
        for key, vector, label in rows
        if key is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for own, vector, label in usable:
        if own % 10:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, other)), key, of) for key, other, of in usable if key != own and len(other) == len(vector)
        ]
        scored.sort()
        for score, positive, _ in [x for x in scored if x[2] == label][:positives]:
            fitting = [x for x in scored if x[2] != label and window[0] * -score <= 100 * -x[0] <= window[1] * -score]
            out += [(own, positive, i + 1, key, -score, -value) for i, (value, key, _) in enumerate(fitting[:negatives])]
    return sorted(out)


def _mined(spark, rows, **settings):
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    frame = frame.withColumns({k: F.lit(v) for k, v in CLASHES.items() if k != "label"})
    found = hard_negatives.mine_hard_negatives(frame, F.col("vec_id") % 10 == 0, settings=hard_negatives.Settings(**settings))
    return sorted(tuple(r) for r in found.collect())


def _vector_rows(seed, count, size=6, grain=4):
    """Vectors of coarse components, so that many scores tie, in three labels."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-1, grain) / grain for _ in range(size)], rng.choice([1, 2, 3])) for i in range(count)]


@pytest.mark.parametrize("shard_rows, clusters", [(131_072, 4), (40, 3), (40, 1)])
def test_negatives_equal_all_pairs(shipped, shard_rows, clusters):
    rows = _vector_rows(1, 200)
    wanted = _negatives(rows)
    assert wanted and _mined(shipped, rows, shard_rows=shard_rows, clusters=clusters, step_rows=8) == wanted


def test_negatives_edge_cases(shipped):
    nan, inf = float("nan"), float("inf")
    rows = _vector_rows(2, 60) + [
        (100, None, 1), (110, [0.1, None], 1), (120, [nan] * 6, 1), (130, [inf] * 6, 2), (140, [0.5] * 6, None), (None, [0.5] * 6, 1),
        (150, [0.0] * 6, 1), (151, [0.0] * 6, 2), (160, [], 1), (161, [], 1), (162, [], 2), (170, [0.5, 0.25], 1), (171, [0.5, 0.5], 1),
        (172, [0.25, 0.25], 2), (180, [0.5], 3), (190, [5e6, 5e6, 1.0], 1), (191, [5e6, 1e7, 1.0], 1), (192, [5e6, 1.0, 0.0], 2), (193, [-5e6, 5e6, 0.0], 2),
    ]
    wanted = _negatives(rows)
    assert {150, 160, 170, 190} <= {row[0] for row in wanted}
    assert _mined(shipped, rows, shard_rows=30, clusters=3) == wanted
    assert _mined(shipped, rows[:0]) == []
    assert _mined(shipped, rows, sample_rows=1) == wanted, "sizes that the sample has not seen"


def test_repeated_rows_are_candidates_each_and_asked_once(shipped):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2)]
    assert _mined(shipped, rows) == [(0, 1, 1, 2, 256 * 256, 128 * 256), (0, 1, 2, 2, 256 * 256, 128 * 256)]


def test_a_walk_ends_early_where_directions_cluster():
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(20, 32))
    of = rng.integers(0, 20, 8_000)
    vectors = np.floor(256 * (middles[of] + 0.1 * rng.normal(size=(8_000, 32)))).astype(np.int64)
    shard = hard_negatives.Shard(np.arange(8_000), of, vectors)
    asked = rng.permutation(8_000)[:100]
    centres = hard_negatives.fit_directions(vectors[asked], hard_negatives.Settings(clusters=20))
    cosines = (vectors[asked] / np.linalg.norm(vectors[asked], axis=1, keepdims=True)) @ centres.T
    seen = 0
    for cluster in range(len(centres)):
        own = asked[cosines.argmax(axis=1) == cluster]
        if not len(own):
            continue
        angles = np.arccos(np.clip(cosines[cosines.argmax(axis=1) == cluster, cluster], -1, 1))
        shard.share(cluster, centres[cluster], float(angles.max()))
        members_ = [hard_negatives.Search(int(i), int(of[i]), vectors[i], [(-math.inf, math.inf)], True, 5) for i in own]
        shard.walk(members_)
        for member in members_:
            scores = vectors @ member.vector
            fit = np.flatnonzero((of == member.label) & (np.arange(8_000) != member.own))
            assert member.ids[0].tolist() == fit[np.lexsort((fit, -scores[fit]))][:5].tolist()
            seen += member.seen
    assert seen < 0.5 * 100 * 8_000


def test_digest_is_that_of_the_payload():
    assert warc.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(warc.payload_digest(hashlib.sha1(b"x").digest())) == 32
