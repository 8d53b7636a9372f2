from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallyloom.llm import katz

TEXTS = ["A b\x0bc a b", None, "  ", "b b B Äb", "a b c\n", "ä\x1cz"]
TRAIN = [True, True, False, True, False, True]


def numbered():
    rows = pa.record_batch([pa.array(range(6)), pa.array(TEXTS), pa.array(TRAIN)], ["key", "text", "train"])
    return katz.numbered([rows.slice(0, 4), rows.slice(4)], 3).to_pandas()


@pytest.mark.parametrize("split", [2, 1 << 19])
def test_words_are_numbered_once(monkeypatch, split):
    """What travels holds the words' numbers, so no later visit to a block reads a text again."""
    want = [[katz.word_hash(w) for w in katz.words_of(t)] for t in TEXTS]
    frames = numbered()
    monkeypatch.setattr(katz, "words_in", None)
    monkeypatch.setattr(katz, "CONTEXT_TOKENS", split)
    block = katz.Block(frames)
    assert [list(x) for x in np.split(block.hashes[block.code], block.starts[1:])] == want
    assert block.docs["key"].tolist() == list(range(6)) and block.docs["train"].tolist() == TRAIN

    single = Counter(h for hashes, train in zip(want, TRAIN) if train for h in hashes)
    asks = katz._ask_words(5)(frames)
    parts = [group.reset_index(drop=True) for _, group in asks.groupby("part")]
    counts = block.counts(pd.concat(map(katz._answer_words, parts)), 5)
    assert dict(zip(block.hashes.tolist(), counts.tolist())) == {
        h: single[h] for h in block.hashes.tolist()
    }
    facts = pd.concat(map(katz._count_words, parts)).sum()
    assert facts["tokens"] == single.total() and facts["vocabulary"] == len(single)
    assert [facts[f"w{r}"] for r in range(1, 7)] == [list(single.values()).count(r) for r in range(1, 7)]

    found = block.pairs(counts, 5)
    real = found["follower"] >= 0
    owners = found["owner"][real]
    got = zip(
        found["context_hash"][found["context"][owners]].tolist(),
        block.hashes[found["follower"][real]].tolist(),
        found["seen"][real].tolist(),
    )
    start = katz.word_hash(katz.START)
    pairs = Counter()
    for hashes, train in zip(want, TRAIN):
        pairs.update({p: 0 for p in zip([start, *hashes], hashes)})
        if train:
            pairs.update(zip([start, *hashes], hashes))
    known = {p: n for p, n in pairs.items() if single[p[1]] and (p[0] == start or single[p[0]])}
    assert {(a, b): n for a, b, n in got} == known
    assert (np.diff(found["part"][found["owner"]]) >= 0).all()
