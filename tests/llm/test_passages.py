"""Repeated passages that hold no run of whole sentences."""

import random

import numpy as np

from tallyloom.llm import substring_dedup


def _sentences(rng, tag, words, longest=40):
    out = []
    while len(out) < words:
        own = [f"{tag}{rng.randrange(10**6)}" for _ in range(rng.randrange(3, longest))]
        out += [*own[:-1], own[-1] + "."]
    return out[:words]


def _windows(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_passages_of_51_to_80_words_are_found_at_any_alignment(docs):
    rng = random.Random(11)
    rows, pasted = [], {}
    for i, length in enumerate([*range(51, 81)] * 6):
        passage = _sentences(rng, "p", length)
        sides = [_sentences(rng, f"s{k}_", rng.randrange(5, 60)) for k in range(4)]
        rows.append((2 * i, " ".join(sides[0][:-1] + ["open"] + passage + ["on"] + sides[1])))
        rows.append((2 * i + 1, " ".join(sides[2][:-1] + ["other"] + passage + ["end"] + sides[3])))
        pasted[2 * i + 1] = passage
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs(*rows)).collect()}
    for key, text in rows:
        left = got[key].text.split()
        if key % 2 == 0:
            assert got[key].text == text and got[key].n_removed == 0
            continue
        own = text.split()
        assert not _windows(left, 51) & _windows(pasted[key], 51), key
        assert len(own) - len(left) >= 25 and got[key].n_removed > 0
        # nothing but words of the passage goes
        assert [w for w in own if w not in pasted[key]] == [w for w in left if w not in pasted[key]]


def test_passage_within_one_text_loses_its_later_place(docs):
    rng = random.Random(3)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(30)) + " mid. " + " ".join(f"q{i}" for i in range(29))
    text = f"first {passage} then something else, and second {passage} at the end"
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs((None, text))).collect()}
    assert got[None].startswith(f"first {passage} then something else, and second ") and got[None].endswith(" at the end")
    assert len(text.split()) - 60 <= len(got[None].split()) <= len(text.split()) - 25


def test_every_stretch_of_44_words_holds_a_picked_run_in_common():
    rng = np.random.default_rng(5)
    hashes = rng.integers(1, 1 << 63, 44).astype(np.uint64)
    seen = []
    for before, after in ((0, 0), (7, 60), (100, 3)):
        around = rng.integers(1, 1 << 63, before + after).astype(np.uint64)
        whole = np.concatenate([around[:before], hashes, around[before:]])
        found = substring_dedup._picked_runs(whole, np.zeros(len(whole), np.int64), 25)
        seen.append(set(found.low[(found.first >= before) & (found.first < before + 20)].tolist()))
    assert set.intersection(*seen)
