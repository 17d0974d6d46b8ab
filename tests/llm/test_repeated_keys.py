"""Near duplicates of keys with several rows."""

from tallyloom.llm import near_dedup
from tests.llm import plain


def _pairs_around_a_passage(pairs):
    """Pairs just above the threshold by one shingle besides the passage that all texts share."""
    passage = " ".join(f"p{i}" for i in range(100))

    def text(pair, side):
        tail = [f"u{pair}_{side}_{i}" for i in range(6)]
        return " ".join([passage, *tail[:3], *(f"c{pair}_{i}" for i in range(3)), *tail[3:]])

    return [(2 * pair + side, text(pair, side)) for pair in range(pairs) for side in range(2)]


def test_repeated_rows_keep_their_links(docs):
    rows = _pairs_around_a_passage(30)
    wanted = plain.near_duplicates(rows)
    assert {own[1] for own in wanted.values()} == set(range(0, 60, 2))
    got = near_dedup.near_duplicates(docs(*rows, *rows[::2], *rows[::4])).collect()
    assert len(got) == 60 + 30 + 15
    assert {r.doc_id: tuple(r)[1:] for r in got} == wanted


def test_each_set_of_a_key_keeps_its_links(docs):
    rows = _pairs_around_a_passage(30)
    other = [(2 * pair, f"short text {pair} of the same key " * 3 + f"end {pair}") for pair in range(30)]
    got = near_dedup.near_duplicates(docs(*rows, *other)).collect()
    assert {r.doc_id: r.component_id for r in got} == {key: key - key % 2 for key, _ in rows}
