"""The tokenizer's shortcuts against their plain forms."""

import itertools
import random
import re

from siftstone.llm import sentpiece
from siftstone.llm.queries import PIECES


def plain_merges(rank, text):
    parts = list(text)
    while True:
        tried = [(rank[a + b], k) for k, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in rank]
        if not tried:
            return parts
        k = min(tried)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_pairs_and_ends_equal_plain_forms():
    enc = sentpiece.Encoder(sentpiece.load_pieces(PIECES))
    rank, rnd = enc.p.rank, random.Random(4)
    names = sorted(enc.whole)
    for _ in range(3_000):
        x, y = rnd.choice(names), rnd.choice(names)
        assert enc.merged(x + y) == plain_merges(rank, x + y)
        assert enc.pair(enc.whole[x], enc.whole[y]) == (plain_merges(rank, x + y) == [x, y]), (x, y)
    for t in rnd.sample([n for n in names if len(n) > 1], 2_000):  # halves of a piece, which merge over the border
        for k in range(1, len(t)):
            if t[:k] in enc.whole and t[k:] in enc.whole:
                assert not enc.pair(enc.whole[t[:k]], enc.whole[t[k:]])
        ends = [t[-l:] for l, i in enc.ending(t[-sentpiece.TAIL :].rjust(sentpiece.TAIL, "\n")) if l <= len(t) and (i >= 0 or t[-l:] in enc.whole)]
        assert ends == [t[k:] for k in range(len(t)) if t[k:] in enc.whole]


def test_runs_do_not_go_back_over_letters():
    """The pattern takes letters and spaces for good, and gives the runs that a pattern with backtracking gives."""
    enc = sentpiece.Encoder(sentpiece.load_pieces(PIECES))
    assert "++" in enc.run.pattern
    back, rnd = re.compile(enc.run.pattern.replace("++", "+").replace("*+", "*")), random.Random(9)
    for _ in range(4_000):
        text = "".join(rnd.choice("▁▁ab1é.,;\n$") for _ in range(rnd.randrange(30)))
        assert enc.run.findall(text) == back.findall(text) and "".join(enc.run.findall(text)) == text
