"""Language ID of texts of several megabytes."""

import random

from strandframe.llm import language_id

SYLLABLES = {"en": "th he in er an re on at ing ed".split(), "fr": "eau le qu on ai ment oi que é çe".split()}


def words(seed, n, syllables):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_long_clean_texts():
    """The margin doesn't fall with the length, so a clean text isn't rejected for being long."""
    classify = language_id.Classifier({x: language_id.words_of(words(1, 40_000, s)) for x, s in SYLLABLES.items()})
    for lang, syllables in SYLLABLES.items():
        text = words(2, 700_000, syllables)
        assert len(text) > 2_500_000
        short, long = classify(text[: language_id.BLOCK_BYTES]), classify(text)
        assert short[0] == long[0] == lang and not short[2] and not long[2]
        assert long[1] > 0.5 * short[1]


def test_blocks():
    for n in (1, 2, language_id.BLOCK_BYTES, language_id.BLOCK_BYTES + 1, 5 * language_id.BLOCK_BYTES + 3):
        data = random.Random(n).randbytes(n)
        blocks = language_id.blocks_of(data)
        assert b"".join(blocks) == data and 0 < min(map(len, blocks)) and max(map(len, blocks)) <= language_id.BLOCK_BYTES
