"""Parts that are ASCII letters alone need no matching, and have the same ids."""

import random

import public_tokenizers

from driftvault.llm import prefix_bpe


def test_letters_are_not_matched_and_have_the_same_ids():
    vocabulary = prefix_bpe.Vocabulary(prefix_bpe.load_tokens(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    quick, plain = (prefix_bpe.TextEncoder(vocabulary, public_tokenizers.PATTERN, 50) for _ in range(2))
    plain._letters = None
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "Zq", "the", " ", "  ", "\n", "\x1c", "'s", "'", "é", "ß", "7", "!", "ﬁ", "x" * 70]) for _ in range(60)) for _ in range(400)]
    assert [quick.encode(t) for t in texts] == [plain.encode(t) for t in texts]
    asked, kept = [], quick._matches
    quick._matches = lambda part: asked.append(part) or kept(part)
    quick.encode("some unseenwordly words, and can't")
    assert asked == [" words,", " can't"]


def test_other_patterns_match_letters_themselves():
    vocabulary = prefix_bpe.Vocabulary([bytes([b]) for b in range(256)])
    for pattern in (r"ab| ?\p{L}+|.", r"\p{L}{1,2}|.", r" ?\p{L}+"):
        assert prefix_bpe.TextEncoder(vocabulary, pattern)._letters is None
