"""Plain versions of the corpus operators, for small inputs."""

import re

import numpy as np

from tallyloom.llm.word_hash import mix, word_hashes


def picked(word):
    """Whether a long stretch is cut after this word."""
    return int(word_hashes(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0][0]) % 16 == 0


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def shingle_set(text, size):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def near_duplicates(rows, size=3, percent=85):
    """{key: (n_shingles, component_id, kept)} for unique keys."""
    sets = {key: shingle_set(text, size) for key, text in rows}
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                one, other = sorted((find(a), find(b)))
                root[other] = one
    return {key: (len(sets[key]), find(key), find(key) == key) for key in keys}


def sentences_of(data, places):
    """Sentences as lists of (begin, end) of their words."""
    stretches, own = [], []
    for k, (begin, end) in enumerate(places):
        own.append((begin, end))
        following = places[k + 1][0] if k + 1 < len(places) else len(data)
        if data[end - 1 : end] in (b".", b"!", b"?") or b"\n" in data[end:following] or k + 1 == len(places):
            stretches.append(own)
            own = []
    found = []
    for stretch in stretches:
        own = []
        for k, (begin, end) in enumerate(stretch):
            own.append((begin, end))
            if k + 1 == len(stretch) or len(stretch) > 32 and picked(data[begin:end].lower()):
                found.append(own)
                own = []
    return found


def picked_runs(own, size, near=20):
    """First words of the runs of ``size`` words that have the least hash of ``near`` runs in a row."""
    hashes = [int(word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in own]
    runs = []
    for i in range(len(own) - size + 1):
        total = sum(h * pow(0x9E3779B97F4A7C15, j, 1 << 64) for j, h in enumerate(hashes[i : i + size]))
        runs.append(int(mix(np.array([total % (1 << 64) ^ 0x3C6EF372], np.uint64))[0]))
    found = set()
    for i in range(len(runs) - near + 1):
        least = min(runs[i : i + near])
        found |= {i + j for j in range(near) if runs[i + j] == least}
    return sorted(found)


def without_repeats(rows, sentences=2, least=31, word_runs=True):
    """{key: (text, n_sentences, n_removed)} for unique keys and texts that are not null."""
    firsts, first_word_runs, parsed = {}, {}, {}
    for key, text in sorted(rows):
        data = text.encode()
        places = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
        own = [data[a:b].lower() for a, b in places]
        found = sentences_of(data, places)
        opens = [sum(map(len, found[:i])) for i in range(len(found) + 1)]
        runs = []
        for i in range(len(found)):
            for j in range(i + sentences - 1, len(found)):
                if opens[j + 1] - opens[i] >= least:
                    runs.append((i, j, tuple(tuple(own[opens[k] : opens[k + 1]]) for k in range(i, j + 1))))
                    break
        at = picked_runs(own, least) if word_runs else []
        parsed[key] = (data, places, own, opens, runs, at)
        for i, _, run in runs:
            firsts.setdefault(run, (key, i))
        for i in at:
            first_word_runs.setdefault(tuple(own[i : i + least]), (key, i))
    out = {}
    for key, (data, places, own, opens, runs, at) in parsed.items():
        gone = {w for i, j, run in runs if firsts[run] != (key, i) for w in range(opens[i], opens[j + 1])}
        for i in at:
            first_key, first = first_word_runs[tuple(own[i : i + least])]
            again = first_key != key or i - first >= least
            if again:
                gone |= set(range(i, i + least))
        if gone:
            begins = [a for a, _ in places] + [len(data)]
            data = data[: begins[0]] + b"".join(data[begins[w] : begins[w + 1]] for w in range(len(own)) if w not in gone)
        removed = sum(bool(gone & set(range(a, b))) for a, b in zip(opens, opens[1:]))
        out[key] = (data.decode(), len(opens) - 1, removed)
    return out
