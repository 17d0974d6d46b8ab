"""Near duplicates, repeated passages and fingerprints."""

import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import fingerprint, near_dedup, substring_dedup
from tallyloom.llm.components import components
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.word_hash import run_hashes, word_hashes
from tests.llm import plain
from tests.llm.conftest import CLASHES, DATA


def _text(rng, length, vocabulary=500):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(length))


def _edited(rng, text, edits):
    own = text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
    return " ".join(own)


def test_word_hashes_equal_words_and_runs():
    texts = [b"", b"  ", b" a", b"a b", b"A  b\n", b"\x0b\x0ca\tb c", "é É".encode(), b"x" * 300, b"x" * 299 + b"y", b"a b c a b c"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, counts = word_hashes(data, offsets)
    own = [t.lower().split() for t in texts]
    assert counts.tolist() == list(map(len, own))
    seen = {}
    for word, value in zip([w for t in own for w in t], hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    runs, number = run_hashes(hashes, counts, 3)
    assert number.tolist() == [min(len(t), 1) if len(t) < 3 else len(t) - 2 for t in own]
    assert len(set(runs.tolist())) == len({tuple(t[i : i + 3]) for t in own for i in range(max(1, len(t) - 2)) if t})


def test_components_of_chains_stars_and_loops(shipped):
    rng = random.Random(4)
    order = list(range(300))
    rng.shuffle(order)
    edges = list(zip(order[:200], order[1:200])) + [(order[250], x) for x in order[251:]] + [(7, 7)] + [(order[0], order[1])]
    got = dict(tuple(r) for r in components(shipped.createDataFrame(edges, "a long, b long")).collect())
    assert {got[x] for x in order[:200]} == {min(order[:200])}
    assert {got[x] for x in order[250:]} == {min(order[250:])}
    assert components(shipped.createDataFrame([], "a long, b long")).collect() == []


def test_matches_needed_bounds_the_chance_of_a_miss():
    assert near_dedup.matches_needed(85) < near_dedup.matches_needed(95) <= near_dedup.COORDINATES
    assert near_dedup.matches_needed(85, miss=1e-3) > near_dedup.matches_needed(85, miss=1e-9)


def _group_rows(seed, groups=12):
    """Groups of copies around the threshold, large and small, and texts that share a passage."""
    rng = random.Random(seed)
    passage = _text(rng, 40)
    rows = []
    for group in range(groups):
        base = _text(rng, rng.choice([5, 30, 80, 150]))
        for _ in range(40 if group == 0 else rng.randrange(1, 8)):
            rows.append(_edited(rng, base, rng.randrange(0, 6)))
    rows += [passage + " " + _text(rng, 60) for _ in range(30)]
    rows += ["", "   \n", "one", "ONE", "one two", "one  two", "a b a b a b a b", "a b a b"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_pairs_are_kept_by_their_collisions(shipped):
    """Three posted and two further coordinates in common: enough of each count, or of neither."""
    row = [(list(range(10, 16)), [1, 2, 3, 4], [3, 15, 11, 10, 99], [1, 0, 3, 0])]
    pair = shipped.createDataFrame(
        row, "a_posts array<int>, a_further array<int>, b_posts array<int>, b_further array<int>"
    )
    for asked, kept in [((3, 5), True), ((4, 5), False), ((3, 6), False), ((0, 0), True)]:
        assert pair.select(near_dedup._collide(asked)).first()[0] is kept


@pytest.mark.parametrize("seed, size, percent, further", [(1, 3, 85, near_dedup.FURTHER), (2, 5, 80, 0)])
def test_near_duplicates_equal_all_pairs(docs, seed, size, percent, further):
    rows = _group_rows(seed)
    got = near_dedup.near_duplicates(docs(*rows), size=size, percent=percent, further=further).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain.near_duplicates(rows, size, percent)


def test_near_duplicates_edge_cases(docs):
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (None, "same text here"), (5, "same text here"), (4, "Same TEXT here"), (4, "other words now"),
            (6, "other words now"), (7, long), (8, long), (9, None)]
    got = sorted(map(tuple, near_dedup.near_duplicates(docs(*rows)).collect()), key=repr)
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (9, 0, 9, True), (None, 1, None, True), (5, 1, 4, False), (4, 1, 4, True),
         (4, 1, 4, True), (6, 1, 4, False), (7, 1, 7, True), (8, 1, 7, False)],
        key=repr,
    )
    assert near_dedup.near_duplicates(docs((1, "x")).limit(0)).collect() == []


def test_near_duplicates_do_not_expand_a_large_group(docs):
    """A group of copies meets one of its members a list, not every other member."""
    rng = random.Random(9)
    base = _text(rng, 100)
    rows = [(i, _edited(rng, base, 1)) for i in range(400)]
    got = near_dedup.near_duplicates(docs(*rows)).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(r.kept for r in got) == 1


def test_substring_query_equals_plain_version(shipped, stored):
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in QUERIES["op4_substring_dedup"](shipped, DATA).collect()}
    assert got == plain.without_repeats(stored.items())
    assert any(removed for _, _, removed in got.values())


def test_substring_edge_cases(docs):
    passage = "one two three four five six seven eight nine ten. " * 2 + "A b c d e f g h i j! "
    other = "Quite another sentence with many words that nobody else has ever written down. And one more after it, for the number of words?"
    long = "".join(f"Sentence number {i} has words of its own, and some more of them {i}.\n" for i in range(20_000))
    rows = [
        (1, passage + other), (2, "Before it. " + passage + "After it."), (3, passage.upper()), (4, None), (5, ""),
        (6, "  \n" + passage.replace(" ", "\n") + "end"), (7, other + " " + other), (8, long), (9, "x. " * 50),
        (10, "Short. Short. Short."), (None, passage),
    ]
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in substring_dedup.remove_repeats(docs(*rows), words=25).collect()}
    wanted = plain.without_repeats([(k, t) for k, t in rows if k is not None and t is not None], least=25)
    assert {k: v for k, v in got.items() if k in wanted} == wanted
    assert got[2][0] == "Before it. After it." and got[3][0] == "" and got[1][2] == 0
    assert got[4] == (None, 0, 0) and got[None] == (passage, 3, 0)
    columns = substring_dedup.remove_repeats(docs((1, "x"))).columns
    assert set(CLASHES) <= set(columns)
    assert substring_dedup.remove_repeats(docs((1, "x")).limit(0)).collect() == []


def test_substring_passage_without_a_sentence_end_is_found(docs):
    rng = random.Random(6)
    passage = _text(rng, 200, 10_000)
    rows = [(1, "before it " + passage + " after it"), (2, _text(rng, 9) + " " + passage + " " + _text(rng, 9))]
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs(*rows)).collect()}
    assert got[1] == rows[0][1]
    assert len(got[2].split()) < 80
    assert got == {key: text for key, (text, _, _) in plain.without_repeats(rows).items()}


@pytest.mark.parametrize("seed", range(3))
def test_substring_any_fifty_words_in_a_row_are_found(docs, seed):
    """Passages of 51 to 80 words pasted into the middle of sentences lose all but a few words at the ends."""
    rng = random.Random(seed)
    passages = [_text(rng, rng.randrange(51, 81), 10_000) for _ in range(20)]
    sentence = lambda: " ".join(_text(rng, rng.randrange(3, 30), 10_000).split()) + ". "
    rows = [(i, sentence() + _text(rng, 7, 10_000) + f" {p} " + _text(rng, 5, 10_000) + ". " + sentence()) for i, p in enumerate(passages * 2)]
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs(*rows)).collect()}
    assert got == {key: text for key, (text, _, _) in plain.without_repeats(rows).items()}
    for i, passage in enumerate(passages):
        assert got[i] == rows[i][1]
        left = len(got[20 + i].split()) - (len(rows[20 + i][1].split()) - len(passage.split()))
        assert left <= 2 * (substring_dedup.NEAR - 1)


def test_substring_word_runs_are_apart_from_sentence_runs(stored):
    """With sentences alone some passages are missed; word runs only add to what goes."""
    alone, both = (plain.without_repeats(stored.items(), word_runs=runs) for runs in (False, True))
    assert all(both[key][2] >= alone[key][2] for key in alone)
    assert sum(both[key][2] for key in both) > sum(alone[key][2] for key in alone)


def test_substring_repeats_of_one_key_stay(docs):
    text = "A passage that has more than twenty five words in it so that it would count. It goes on for a while, as such passages do, and then it ends."
    got = substring_dedup.remove_repeats(docs((1, text), (1, text), (2, text)), words=25).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text), (1, text), (2, "")]


def test_fingerprint_is_a_homomorphism():
    parts = [f"paragraph number {i}, of some words".encode() for i in range(50)] + [b"", b"x"]
    whole = fingerprint.vectors([parts])[0]
    rng = random.Random(1)
    assert (fingerprint.vectors([rng.sample(parts, len(parts))])[0] == whole).all()
    without = fingerprint.vectors([parts[:10] + parts[11:]])[0]
    assert (whole - fingerprint.vectors([[parts[10]]])[0] == without).all()
    assert (fingerprint.vectors([parts[:20]])[0] + fingerprint.vectors([parts[20:]])[0] == whole).all()
    assert (fingerprint.vectors([[b"a b"]]) != fingerprint.vectors([[b"A b"]])).any()
    assert (fingerprint.vectors([[b"a", b""]]) != fingerprint.vectors([[b"a"]])).any()


def _fingerprints(rows):
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        one, two, three = fingerprint.vectors([fingerprint.paragraphs(t) for t in (text, changed, following)])
        near = lambda a, b: round(float(fingerprint.likeness(a[None], b[None])[0]), 9)
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), *fingerprint.hexes(np.stack([one, two])),
                    near(one, two), near(one, three)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 5])
def test_fingerprint_edge_cases_equal_plain_version(docs, ranges):
    rows = [(5, "a\nb\nc\nd"), (3, None), (9, ""), (1, "é🙂" * 40 + "\n"), (2, "x"), (7, "a\n" * 9), (7, "b\n" * 9), (7, "a\n" * 9),
            (None, "no key\nat all"), (-4, "long words here\n" * 50_000), (40, "four"), (10**12, "abcd efgh\n\n")]
    got = fingerprint.fingerprint_documents(docs(*rows), ranges=ranges).collect()
    assert sorted(((*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == _fingerprints(rows)
    assert fingerprint.fingerprint_documents(docs((1, "x")).limit(0), ranges=ranges).collect() == []
    alone = fingerprint.fingerprint_documents(docs((1, "abcdefgh")), ranges=ranges).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_fingerprint_query_tells_edits_from_other_texts(shipped, stored):
    got = QUERIES["op5_fingerprint"](shipped, DATA).collect()
    assert sorted(((*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == _fingerprints(stored.items())
    assert sum(r.near_edited > r.near_next for r in got) >= 0.97 * len(got)
    assert sum(r.near_edited > 0.5 for r in got) >= 0.9 * len(got)
