"""Runs of white space, and the characters that stand for bytes."""

import random
import re
from codecs import charmap_decode

from lumenmart.llm.bpe import byte_letters, letters_table
from lumenmart.llm.segments import _OTHER_SPACE, has_run


def test_runs_are_those_of_the_pattern():
    pattern = re.compile(r"\s[ \n]|[ \n]\s")
    rng = random.Random(3)
    found = 0
    for _ in range(20000):
        text = "".join(rng.choice(["a", "é", "日", " ", "\n", rng.choice(_OTHER_SPACE)]) for _ in range(rng.randint(0, 6)))
        found += has_run(text)
        assert has_run(text) == (pattern.search(text) is not None), repr(text)
    assert 0 < found < 20000


def test_other_spaces_are_all_there_are():
    assert set(_OTHER_SPACE) | {" ", "\n"} == {c for c in map(chr, range(0x110000)) if re.match(r"\s", c)}


def test_every_byte_has_its_letter():
    assert charmap_decode(bytes(range(256)), "strict", letters_table())[0] == "".join(byte_letters()[b] for b in range(256))
