from __future__ import annotations

import random

from millrace.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, extra int"


def test_nested_levels():
    text = "Hi\n> one\n> two\n>> deep\n> > deeper still\n> three\nbye\n>lone"
    own, found = quotes.parse(text)
    assert own == "Hi\nbye"
    assert found == [(1, "one\ntwo"), (2, "deep\ndeeper still"), (1, "three"), (1, "lone")]


def test_links_and_reply_order(spark):
    rows = [
        (1, 0, "user", "What is  Spark?\n\nAnd Catalyst?", 0),
        (1, 1, "user", "Unrelated", 0),
        (1, 2, "assistant", "> what is spark?\nAn engine.", 0),
        (1, 3, "assistant", "> Unrelated\nTrue.", 0),
        (1, 4, "user", "> An engine.\n>> What is Spark?\n> nowhere said\nThanks.", 0),
        (2, 0, "user", "> what is spark?\nother conversation", 0),
        (2, 1, None, None, None),
        (None, None, None, "x", 1),
        (2, 1, None, None, None),
    ]
    found = quotes.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    got = [(r.conv_id, r.turn, r.text, r.n_quotes, r.n_linked, r.reply_to, r.thread) for r in found]
    assert got == [
        (None, None, "x", 0, 0, None, None),
        (1, 0, "What is  Spark?\n\nAnd Catalyst?", 0, 0, None, 0),
        (1, 2, "An engine.", 1, 1, 0, 0),
        (1, 4, "Thanks.", 3, 2, 2, 0),
        (1, 1, "Unrelated", 0, 0, None, 1),
        (1, 3, "True.", 1, 1, 1, 1),
        (2, 0, "other conversation", 1, 0, None, 0),
        (2, 1, "", 0, 0, None, 1),
        (2, 1, "", 0, 0, None, 1),
    ]


def test_long_chain_and_empty_table(spark):
    rows = [(1, i, "user", f"> say {i - 1}\nsay {i}", 0) for i in range(40)]
    found = quotes.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.turn for r in found] == list(range(40)) and {r.thread for r in found} == {0}
    assert quotes.link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0


def plain(lines):
    return " ".join(" ".join(lines).lower().split())


def brute(rows):
    """(conv, turn): passages, those found, and the turn replied to, by comparing all with all."""
    read = {}
    for conv, turn, _, text, _ in rows:
        own, quoted, before = [[]], [], 0
        for line in text.split("\n"):
            rest, level = line, 0
            while rest.lstrip(" \t").startswith(">"):
                rest, level = rest.lstrip(" \t")[1:], level + 1
            if not level:
                own = [*own, []] if before else own
                own[-1].append(line)
            elif level == before:
                quoted[-1][1].append(rest)
            else:
                quoted.append((level, [rest]))
            before = level
        read[conv, turn] = own, quoted
    out = {}
    for (conv, turn), (_, quoted) in read.items():
        found = []
        for level, passage in quoted:
            want = [plain([x]) for x in passage if plain([x])]
            for (c, t), (own, _) in sorted(read.items()):
                every = [x for part in own for x in part]
                have = [plain([x]) for x in every if plain([x])]
                held = any(have[i : i + len(want)] == want for i in range(len(have)))
                held |= plain(passage) in {plain(every), *map(plain, own), *have}
                if c == conv and held:
                    found += [(level, -t)] if t < turn else []
                    break
        out[conv, turn] = len(quoted), len(found), -min(found)[1] if found else None
    return out


def test_excerpts_and_interleaved_quotations(spark):
    rows = [
        (1, 0, "user", "one\ntwo\n\nthree", 0),
        (1, 1, "user", "> one\n> two\nyes", 0),
        (1, 2, "user", "> Two\n> three\nno", 0),
        (1, 3, "user", "> one\n> three\nnot in a row", 0),
        (2, 0, "user", "p0\np1\np2\np3", 0),
        (2, 1, "user", "b1\nb2\n> p1\n> p2\nb3\nb4", 0),
        (2, 2, "user", "> b1\n> b2\n>> p1\n>> p2\n> b3\n> b4\nc", 0),
        (2, 3, "user", "> b1 b2\n> b2 b3\nd", 0),
        (2, 4, "user", "> b1 b2\ne", 0),
    ]
    words = random.Random(3)
    for turn in range(60):
        lines = [words.choice(["", "> ", "> ", ">> "]) + f"Line {words.randrange(6)}" for _ in range(words.randint(1, 7))]
        rows.append((3 + turn // 15, turn % 15, "user", "\n".join(lines), 0))
    found = quotes.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to) for r in found}
    assert got == brute(rows)
    assert [got[1, 1], got[1, 2], got[1, 3], got[2, 2], got[2, 4]] == [(1, 1, 0), (1, 1, 0), (1, 0, None), (3, 3, 1), (1, 1, 1)]
