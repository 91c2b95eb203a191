import random
import re

from pyspark.sql import functions as F

from citemill.llm import quality
from tests.llm.plans import plan_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def texts():
    r = random.Random(4)
    bank = ["the", "of", "é", "naïve", "#x", "a|b", "end.", "中文"]
    made = [
        " ".join(r.choice(bank[: r.randrange(1, 9)]) + r.choice(("", "", "\n", "\t", "\x0b")) for _ in range(r.randrange(0, 80)))
        for _ in range(150)
    ]
    return [*made, None, "", " \n\n ", "one", "a b c d e f g h " * 3, "x\x85y z w", "w " * 40_000, "line.\nline.\n\nline. "]


def test_base_rules_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    found = quality.clean_lines(spark.createDataFrame(rows, "id long, text string").repartition(4)).collect()
    assert len(found) == len(rows)
    for x in found:
        want = base(rows[x.id][1])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, rows[x.id]
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (x.base_failed and x.kept)


def test_lines_go_first_then_documents(spark):
    prose = " ".join(f"Word{k} goes with other{k}." for k in range(12))
    menu = "Home | News | Sport | Contact"
    rows = [
        ("clean", prose),
        ("one bad line", f"{prose}\n{menu}\nAll rights reserved by nobody."),
        ("mostly menu", f"A short line that is fine.\n" + "\n".join(f"{menu} | Page{k}a | Page{k}b" for k in range(20))),
        ("symbols", " ".join(f"w{k}### x{k}$$$" for k in range(30))),
        ("shouting", " ".join(f"WORD{k}!!" for k in range(40))),
        ("no end", " ".join(f"word{k}" for k in range(40))),
    ]
    found = {x.id: x for x in quality.clean_lines(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert {k for k, x in found.items() if x.kept} == {"clean", "one bad line"}
    assert found["clean"].cleaned == prose and found["clean"].lines_removed == 0
    assert found["one bad line"].cleaned == prose and found["one bad line"].lines_removed == 2


def failed_line(line):
    """The rules for symbols, shouting, open ends and navigation, by words."""
    words = WORD.findall(line)
    separators = sum(w in tuple("|»›·•>/") for w in words)
    return (
        10 * len(re.findall(r"[#*$%&|<>]", line)) > sum(map(len, words))
        or 3 <= line.count("!") and len(words) < 3 * line.count("!")
        or len(words) >= 10 and not re.search("[.!?…。！？]", line)
        or 0 < separators and len(words) <= 5 * separators
    )


def test_line_rules_count_words_whatever_parts_them(spark):
    r = random.Random(6)
    parts = (" ", "  ", "\t", " \t", "\x0b", "\x0c", "\r", "     ", "\xa0", "\u2028")
    lines = ["", " ", "\t", " \t ", "!!!", " !!! ", "|", "\t/", "a", " a", "a ", "\u2028", "a \u2028"]
    for part in parts:
        for n in (1, 5, 8, 9, 10, 11, 12, 30):
            words = [f"word{k}" for k in range(n)]
            for extra in ([], ["end."], ["so!!!", "it."], ["·", "is."]):
                line = part.join([*words, *extra])
                lines += [line, part + line, line + part, "    " + line, line.replace(part, " ", 3)]
    lines += ["".join(r.choice(("a", "b!", "/", "c.", "d")) + r.choice(parts[:8]) for _ in range(r.randrange(1, 40))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    found = frame.select("id", F.size(quality.line_failures(F.col("line"))).alias("n")).collect()
    assert {x.id: x.n > 0 for x in found} == {k: bool(failed_line(x)) for k, x in enumerate(lines)}
    text = "\n".join(lines)
    cleaned = quality.clean_lines(spark.createDataFrame([(text,)], "text string")).first()
    assert cleaned.cleaned == "\n".join(x for x in lines if not failed_line(x))
    assert cleaned.lines_removed == sum(map(bool, map(failed_line, lines)))


def test_only_expressions(spark, small):
    text = plan_of(quality.clean_lines(spark.read.parquet(f"{small}/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_clashing_names_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b", "x", 5)], "id long, text string, cleaned string, _lines long")
    found = quality.clean_lines(frame)
    assert found.columns[:3] == ["id", "text", "_lines"] and found.first()["_lines"] == 5
    assert found.first().cleaned == "a b"
    assert quality.clean_lines(frame.limit(0)).isEmpty()
    twice = quality.clean_lines(frame.union(frame)).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
