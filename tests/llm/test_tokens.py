"""New chunks go to the library together, and come back apart."""

from __future__ import annotations

import numpy as np
import public_tokenizers

from roostline.llm.tokens import Encoder


def test_spaced_chunks_are_joined_with_nothing_between(monkeypatch):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "one two, three\nfour  five… é, naïve. \xa3 9's x " + " ".join(f"w{n}q" for n in range(600))
    # Each text alone is what the library says.
    expected = [np.array(ids, "<u4").tobytes() for ids in encoder._ids([text, " a b", "a"])]
    real, given = encoder._ids, []
    monkeypatch.setattr(encoder, "_ids", lambda texts: given.extend(texts) or real(texts))
    assert encoder.encode([text, " a b", "a"]) == expected
    joined = [t for t in given if " w1q" in t or " w599q" in t]
    assert joined and all("\n" not in t for t in joined)
