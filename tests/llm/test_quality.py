import collections

from helpers import SPACE_WORDS, awkward_docs, clashing, frame

from tidemark.llm import quality


def brute(text):
    t = text or ""
    w = SPACE_WORDS.findall(t)
    fives = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if fives[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACE_WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(repeated), len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def test_awkward_rows_match_brute_force(spark):
    rows = awkward_docs()
    rows += [(200, "a\nb\na\n\na\n a\nb", "", "", 0), (201, "one two three four five six\n" * 3 + "end", "", "", 0), (202, "# * $ % & | < > ##x", "", "", 0)]
    docs = clashing(frame(spark, rows), "kept", "n_words", "faults", "clean_text")
    got = sorted(((r[0], tuple(r)[1:7]) for r in quality.digest(quality.quality_rules(docs)).collect()), key=repr)
    assert got == sorted(((r[0], brute(r[1])) for r in rows), key=repr)


def test_empty_table(spark):
    assert quality.digest(quality.quality_rules(frame(spark, []))).collect() == []


def test_line_rules():
    fault = lambda s: quality.line_fault(s.encode())
    assert fault("Home | About | News | Contact") == "navigation"
    assert fault("Start · Produkte · Kontakt · Hilfe") == "navigation"
    assert fault("a### b*** c%%% d word") == "symbols"
    assert fault("BUY!! NOW!! IT!! IS!! CHEAP!!") == "shouting"
    assert fault("We use cookies to make this site better") == "boilerplate"
    assert fault("la la la la la la la la") == "repetition"
    assert fault("A plain sentence, with 50% of one word marked and more of them that are not.") is None
    assert fault("#include <stdio.h>") is None
    assert fault("") is None and fault(" \t") is None
    assert fault("C# and C++ are languages that people use for many things") is None


def test_short_symbol_lines_menus_and_long_notices():
    fault = lambda s: quality.line_fault(s.encode())
    assert fault("$$$ ### %%%") == "punctuation" and fault(". . . . . . .") == "punctuation" and fault("…… ———") == "punctuation"
    assert fault("one... two,, three;; four--- five six") == "punctuation"
    assert fault("});") is None and fault("Yes, we can (really).") is None and fault("नमस्ते दुनिया") is None
    notice = "We use cookies as our cookie policy and our privacy policy and the terms of service say and all rights reserved."
    assert fault(notice) == "boilerplate"
    assert quality.without_notices((notice + " " + "So " * 40 + "it ends.").encode()).decode() == "So " * 40 + "it ends."
    assert fault("word other " * 100 + "click here") is None
    menu = "Home\nAbout us\n\nNews\nContact\nOur shop\nHelp"
    text = "A sentence of plain words that stays here, and some more of them to be safe."
    got = quality.judge(f"{menu}\n{text}", 0.5)
    assert got["kept"] and got["clean_text"].strip() == text and got["faults"] == "navigation:6"
    assert not quality.judge(menu + "\nSearch box here\nSitemap", 0.5)["kept"]
    assert quality.judge(f"{text}\n\nHome\nAbout us\nNews\nContact\nShop", 0.5)["lost_words"] == 0
    assert not quality.judge("$$$ ### %%%\n" + "\n".join(f"*** {c}{c} ### &&&" for c in "#%&$") + "\n.....", 0.5)["kept"]


def test_lines_go_first_then_documents():
    good = "This is a line of plain words that stays in the text."
    bad = "a### b*** c%%% d### e$$$"
    kept = quality.judge(f"{good}\n{bad}\nAnother line ends it.", 0.5)
    assert kept["kept"] and kept["clean_text"] == f"{good}\nAnother line ends it." and kept["lost_words"] == 5
    gone = quality.judge(f"{bad}\nf### g*** h%%% i### j$$$ k%%%\n{good}", 0.4)
    assert not gone["base_failed"] and not gone["kept"]
    assert quality.judge("w" * 100_000 + " x" * 9, 0.5)["n_words"] == 10


def test_repeated_words_overlap():
    w = b"a b c d e f a b c d e f a".split()
    assert quality.repeated_words(w) == 13
    assert quality.repeated_words([b"x"] * 6) == 6
    assert quality.repeated_words([b"x"] * 5) == 0


PROSE = [
    "In the spring the committee met again and read, line by line, the privacy policy that the ministry had proposed two years before, and nobody in the room could say what it meant.",
    "On the last page of the book, below a drawing of the harbour and the names of the people who had paid for it, stood the words all rights reserved, as if anybody in that town would have wished to copy it at all.",
    "The minister defended the new privacy policy yesterday.",
    "London\nParis\nBerlin\nMadrid\nRome\nVienna",
    "Flour\nSugar\nButter\nFour eggs\nVanilla\nSalt\nBaking powder",
    "Er las die Datenschutzerklärung zweimal und verstand sie trotzdem nicht ganz.",
]


def test_prose_that_names_a_notice_and_lists_stay():
    for text in PROSE:
        got = quality.judge(f"{text}\n{'Some plain words follow here to be long enough.'}", 0.5)
        assert got["lost_words"] == 0 and got["kept"] and got["clean_text"].startswith(text), text


def test_notices_in_four_languages():
    for notice in ("Alle Rechte vorbehalten.", "Tous droits reserves", "Tous droits réservés.", "Diese Website verwendet Cookies.", "Todos los derechos reservados", "Ce site utilise des cookies.", "Este sitio utiliza cookies.", "© 2024 Acme. All rights reserved.", "Datenschutzerklärung", "Privacy Policy"):
        keep = "A line of plain words that stays in the text, whatever stands below it."
        got = quality.judge(f"{keep}\n{notice}", 0.5)
        assert got["clean_text"].rstrip() in (keep, f"{keep}\n© 2024 Acme."), notice
        assert got["faults"] == "boilerplate:1"
    got = quality.judge("One two three four five six. We use cookies here. Seven eight nine ten eleven twelve.", 0.5)
    assert got["clean_text"] == "One two three four five six. Seven eight nine ten eleven twelve." and got["lost_words"] == 4
