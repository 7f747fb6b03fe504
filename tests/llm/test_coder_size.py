"""How small the coder makes ids that it can't predict."""

from __future__ import annotations

import numpy as np

from precis.llm import coder, tokenizing
from precis.llm.queries import tokenizer_path


def test_frequencies_follow_a_block_that_changes():
    rng = np.random.default_rng(3)
    # Every 256 ids the upper bytes come from eight others; no id is foretold by those before it.
    upper = np.repeat(np.arange(8), 256) * 8 + rng.integers(0, 8, (16, coder.BLOCK))
    ids = upper << 8 | rng.integers(0, 256, upper.shape)
    out = coder.encode_blocks(ids)
    assert (coder.decode_blocks(out, coder.BLOCK) == ids).all()
    assert sum(map(len, out)) / ids.size < 2.1


def test_blocks_whose_id_was_foretold_are_looked_at_once_for_settled_words(monkeypatch):
    """After the lower bits only blocks with a new id can have words to move; all others were looked at before."""
    whole, shift = [], coder._shift

    def spy(low, span, move, *rows):
        whole.append(not rows)
        return shift(low, span, move, *rows)

    monkeypatch.setattr(coder, "_shift", spy)
    ids = np.tile(np.random.default_rng(4).integers(0, 50_000, 16), (4, 8))
    out = coder.encode_blocks(ids)
    assert sum(whole) == ids.shape[1]
    whole.clear()
    assert (coder.decode_blocks(out, ids.shape[1]) == ids).all()
    assert sum(whole) == ids.shape[1]


def test_distinct_pieces_of_a_batch_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def __missing__(self, key):
            number = self[key] = len(self)
            return number

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    codes = tokenizing.Encoder(tokenizer_path())
    codes.number = Counted()
    texts = ["one two one two \u201ctwo\u201d \u3000 one"] * 100
    ids, counts = codes.encode(texts)
    assert ids.tolist() == [i for t in texts for i in codes.tokenizer.encode(t, add_special_tokens=False).ids]
    assert Counted.asked == len(codes.number) <= 8
