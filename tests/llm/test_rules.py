from __future__ import annotations

import random
import re
from collections import Counter

from stockledger.llm import rules as R
from stockledger.llm.common import Shared

from .edge import ROWS, empty, frame


def measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {p for i, g in enumerate(grams) if g in twice for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    rng = random.Random(1)
    rows = list(ROWS)
    for i in range(100, 160):
        voc = ["".join(rng.choice("ab#é<𝔘") for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([2, 5, 40]))]
        rows.append((i, "".join(rng.choice(voc) + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for _ in range(rng.randint(0, 80)))))
    once = " ".join(f"word{i}" for i in range(60))
    rows.append((200, once + " " + " ".join(once.split()[5:14])))  # little is repeated
    out = R.apply_rules(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "cast(null as string) as source", "9 as n_words"), "doc_id", "text", "source", Shared(spark, "r")).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=str)
    assert got == sorted(((d, *measures(t)) for d, t in rows), key=str)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in out)
    assert any(r.n_repeat_words and not r.base_failed for r in out)


def test_frequent_lines_deplete_documents(spark):
    rng = random.Random(2)
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(n))
    menu = own(25)
    rows = [(i, f"{menu}\n{own(40)}", "a") for i in range(30)]  # the menu line is common, the rest is not
    rows += [(100 + i, f"{menu.upper()} \n{own(4)}", "a") for i in range(5)]  # little beside the menu
    rows += [(200 + i, f"{menu}\n{own(4)}", "b") for i in range(5)]  # another host: not common there
    copies = own(30)
    rows += [(300 + i, copies, "a") for i in range(40)]  # a page copied under many ids is boilerplate
    rows += [(400, own(30), "a")] * 40  # rows of one document are one document
    spam = own(3)
    rows += [(500 + i, f"{spam}\n{own(4)}", "a") for i in range(25)]
    rows += [(600, "\n".join(f"{spam}\n{own(1)}" for _ in range(30)), "a")]  # 120 words, 90 of them one line over and over
    rows += [(700 + i, f"{menu}\n{own(4)}", None) for i in range(15)] + [(800 + i, f"{menu}\n{own(4)}", "") for i in range(15)]  # 15 documents each, not 30 of one host
    out = {r.doc_id: r for r in R.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), "doc_id", "text", "source", Shared(spark, "r")).collect()}
    assert all(out[i].kept for i in [*range(30), *range(200, 205), 400, *range(700, 715), *range(800, 815)])
    assert not any(out[i].kept for i in range(100, 105)) and out[100].n_boilerplate_words == 25 and not out[100].base_failed
    assert not any(out[i].kept for i in range(300, 340)) and out[300].n_boilerplate_words == 30
    assert not out[600].kept and out[600].n_boilerplate_words == 90 and not out[600].base_failed


def test_odd_frames(spark):
    assert R.apply_rules(empty(spark), "doc_id", "text", "source", Shared(spark, "r")).count() == 0
    out = R.apply_rules(frame(spark), "doc_id", "text", "source", Shared(spark, "r"))
    assert out.count() == len(ROWS) and not out.where("doc_id <= 3 and kept").count()
