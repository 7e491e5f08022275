"""The near-duplicate stage gets its candidates by SimHash votes and Golay indices."""

import random

import numpy as np

from tessera.llm import nearcopies as N
from tessera.llm import simhash as S


def test_soft_decoding_agrees_with_hard_where_votes_are_equally_strong():
    """Up to three bits from a codeword, equal votes decode to it; a strong vote outweighs several weak ones."""
    rng, signs = random.Random(1), S._codeword_signs()
    for _ in range(200):
        k = rng.randrange(4096)
        word = signs[:, k >> 1] * (-1 if k & 1 else 1)
        votes = word.copy()
        votes[rng.sample(range(24), 3)] *= -1
        weak = word * 50
        weak[rng.sample(range(24), 5)] *= -0.1
        assert S.soft_golay_index(np.stack([votes, weak])).tolist() == [k, k]
    hard = S.golay_index(np.arange(1 << 23)[:: 1 << 12])
    assert hard.max() < 4096 and len({bytes(x) for x in signs.T.astype(np.int8)}) == 2048


def test_pairs_at_exactly_the_threshold_share_golay_keys():
    rng, texts = random.Random(5), []
    for n in (9, 36, 90, 450):  # shingles; the last ninth of them differ, a similarity of 0.8
        for _ in range(60):
            base = [str(rng.random()) for _ in range(n + 4)]
            texts += [" ".join(base), " ".join(base[: n + 4 - n // 9] + [str(rng.random()) for _ in range(n // 9)])]
    table = S.vote_rows(N.VOTE_ROWS, 48 * N.TABLES)
    parts = [N.prints(texts[at : at + 40], table) for at in range(0, len(texts), 40)]
    keys, bits = np.concatenate([p[2] for p in parts]), np.concatenate([p[1] for p in parts])
    common = (keys[::2] == keys[1::2]).sum(1)
    apart = [sum(bin(int(x) & (1 << 64) - 1).count("1") for x in row) for row in bits[::2] ^ bits[1::2]]
    assert common.min() >= 1 and 11 < common.mean() < 15 and max(apart) <= N.RADIUS
    assert (keys[::2] == np.roll(keys[1::2], 1, axis=0)).mean() < 0.001
