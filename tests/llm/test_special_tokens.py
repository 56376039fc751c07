import random

import public_tokenizers
from tokenizers import Tokenizer

from driftvault.llm import packing

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_untouched_tokenizer():
    rng, judge, ours = random.Random(8), Tokenizer.from_file(JSON), packing.FileTokenizer(JSON)
    special = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "漢字 <|endoftext|>", "<|endoftext", "<|other|>"]
    latin = ["".join(chr(rng.choice([32, 10, 39, rng.randrange(33, 127), rng.randrange(161, 592)])) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for text in special + latin:
        assert ours.encode(text) == judge.encode(text, add_special_tokens=False).ids, text
    assert 50256 in ours.encode(special[0])


def test_every_latin_character_has_the_same_ids():
    judge, ours = Tokenizer.from_file(JSON), packing.FileTokenizer(JSON)
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f"1{c}2", f" {c}", f"{c}{c} {c}", f"'{c}", f"{c}'s", f"x {c}\n{c}", f"\t{c}\r\n "):
            assert ours.encode(text) == judge.encode(text, add_special_tokens=False).ids, (hex(ord(c)), text)
