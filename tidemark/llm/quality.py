"""Line-first quality rules.

Each line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed; a document that loses too much of its text is rejected.  The
document-level base rules (few words, many repeated five-word windows) come on
top.  All work stays inside the task that reads the document: no shuffle.

Line rules (a line without a word is neither judged nor counted):

* ``symbols``: of five words or more, at least 0.3 hold one of ``#*$%&|<>``;
* ``punctuation``: five or more characters that are no letter, digit or white space,
  and at least 0.7 of the line's characters are (white space aside), whatever its
  words; or, of five words or more, at least 0.6 end in a run of two such marks;
* ``shouting``: of five words or more, at least 0.6 end in ``!!``;
* ``navigation``: two or more separators (``|``, ``>``, a middle dot, a guillemet)
  standing alone, at least one for each four words; or a run of six or more lines
  (blank ones aside) of at most three words that begin with a capital and end in a
  letter or digit, of which two or more, and a quarter, are known items of menus (a list
  of cities or of ingredients is none);
* ``boilerplate``: a sentence of which notice phrases make up a quarter (half for phrases that are
  also written about), in four languages.  The sentence goes, the rest of the line stays;
* ``repetition``: of eight words or more, at least half equal the word before them.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; nulls elsewhere pass through; repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts

SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset((b"|", b">", b">>", "·".encode(), "»".encode(), "›".encode()))
# Phrases of notices (lower case, UTF-8).  The first are hardly written but in a
# notice, the second are also written about.
NOTICES = tuple(
    p.encode()
    for p in (
        "use cookies", "uses cookies", "all rights reserved", "click here", "subscribe to our newsletter", "enable javascript", "skip to content",
        "verwendet cookies", "verwenden cookies", "alle rechte vorbehalten", "hier klicken", "klicken sie hier", "newsletter abonnieren", "javascript aktivieren", "zum inhalt springen",
        "utilise des cookies", "utilisons des cookies", "tous droits réservés", "tous droits reserves", "cliquez ici", "abonnez-vous à notre newsletter", "activer javascript", "aller au contenu",
        "usa cookies", "utiliza cookies", "usamos cookies", "utilizamos cookies", "todos los derechos reservados", "haga clic aquí", "suscríbase a nuestro boletín", "activar javascript", "saltar al contenido",
    )
)
TOPICS = tuple(
    p.encode()
    for p in (
        "cookie policy", "privacy policy", "terms of service", "terms of use", "datenschutzerklärung", "nutzungsbedingungen",
        "politique de confidentialité", "conditions d'utilisation", "política de privacidad", "política de cookies", "términos de uso",
    )
)
# Items that menus have (lower case).
MENU_ITEMS = frozenset(
    "home|about|about us|contact|contact us|news|login|log in|sign in|sign up|register|help|faq|search|search box here|sitemap|site map|shop|our shop|blog|imprint|"
    "start|startseite|über uns|kontakt|impressum|datenschutz|hilfe|suche|anmelden|registrieren|produkte|accueil|à propos|contactez-nous|aide|recherche|connexion|"
    "s'inscrire|plan du site|mentions légales|inicio|acerca de|quiénes somos|contacto|noticias|ayuda|buscar|iniciar sesión|mapa del sitio|tienda".split("|")
)
_SENTENCE = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+")
ALNUM = bytes(c for c in range(128) if chr(c).isalnum())
_MARKS = re.compile(r"[^\w\s]|_")
_RUN_END = re.compile(rb"[?.,;:~_=-]{2}(?=[\x20\x09-\x0D]|\Z)")
#: A menu without separators: so many short lines in a row.
MENU_LINES, MENU_WORDS = 6, 3
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOSS = 0.5


def line_fault(line: bytes, notices: bool = True) -> str | None:
    """The rule that a line (UTF-8) fails, or None; without ``notices`` the line is known to hold no notice."""
    words = line.split()
    n = len(words)
    if not n:
        return None
    marked = line.translate(None, SYMBOLS)
    if len(marked) != len(line):
        alone = sum(w in SEPARATORS for w in words)
        if alone >= 2 and 4 * alone >= n:
            return "navigation"
        if n >= 5 and 10 * sum(len(w.translate(None, SYMBOLS)) != len(w) for w in words) >= 3 * n:
            return "symbols"
    elif n > 3 and (b"\xc2" in line or b"\xe2" in line):
        alone = sum(w in SEPARATORS for w in words)
        if alone >= 2 and 4 * alone >= n:
            return "navigation"
    if n >= 5 and b"!!" in line and 10 * sum(w.endswith(b"!!") for w in words) >= 6 * n:
        return "shouting"
    if n >= 5 and 10 * len(_RUN_END.findall(line)) >= 6 * n:
        return "punctuation"
    full = sum(map(len, words))
    if full >= 5 and 10 * (len(line) - len(line.translate(None, ALNUM))) <= 3 * full:
        text = line.decode("utf-8", "surrogatepass")
        marks = len(_MARKS.findall(text))
        if marks >= 5 and 10 * marks >= 7 * sum(map(len, text.split())):
            return "punctuation"
    if notices and not without_notices(line).strip():
        return "boilerplate"
    if n >= 8 and 2 * sum(map(bytes.__eq__, words, words[1:])) >= n:
        return "repetition"
    return None


def without_notices(line: bytes) -> bytes:
    """The line without its sentences that are notices."""
    low = line.lower()
    if not any(p in low for p in NOTICES) and not any(p in low for p in TOPICS):
        return line
    kept, gone = [], False
    for sentence in _SENTENCE.split(line):
        low, n = sentence.lower(), len(sentence.split())
        strong = sum(low.count(p) * (p.count(b" ") + 1) for p in NOTICES if p in low)
        weak = sum(low.count(p) * (p.count(b" ") + 1) for p in TOPICS if p in low)
        if 4 * strong + 2 * weak >= n > 0 and strong + weak:
            gone = True
        else:
            kept.append(sentence)
    return b" ".join(kept) if gone else line


def is_item(line: bytes) -> bool:
    """Could the line be an item of a menu: few words, a capital first, no sentence end?"""
    if len(line) > 200 or not 0 < len(line.split()) <= MENU_WORDS:
        return False
    text = line.decode("utf-8", "surrogatepass").strip()
    return text[:1].isupper() and text[-1:].isalnum()


def mark_menus(lines: list[bytes], faults: list[str | None]) -> None:
    """Lines of menus without separators become ``navigation``."""
    run: list[int] = []
    for i, line in enumerate([*lines, b"."]):
        if i < len(lines) and (not line.strip() or (faults[i] is None and is_item(line))):
            if line.strip():
                run.append(i)
            continue
        if len(run) >= MENU_LINES:
            known = sum(" ".join(lines[k].decode("utf-8", "surrogatepass").lower().split()) in MENU_ITEMS for k in run)
            if known >= 2 and 4 * known >= len(run):
                for k in run:
                    faults[k] = "navigation"
        run = []


def repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that occurs twice or more (the first included)."""
    n = len(words)
    if n < 6:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    # a window is two overlapping three-word windows; both numbers are below 2**31, so the pairing is exact
    pair = ids[:-1] * len(number) + ids[1:]
    _, two = np.unique(pair, return_inverse=True)
    _, three = np.unique(two[:-1].astype(np.int64) * (len(number) + 1) + ids[2:], return_inverse=True)
    five = three[:-2].astype(np.int64) * n + three[2:]
    _, where, times = np.unique(five, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[where] > 1)
    if not len(again):
        return 0
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, again, 1)
    np.add.at(mark, again + 5, -1)
    return int(np.count_nonzero(np.cumsum(mark[:-1])))


def judge(text: str, max_loss: float) -> dict:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = raw.split(b"\n")
    seen: set[bytes] = set()
    dup, kept, lost, faults = 0, [], 0, Counter()
    low = raw.lower()
    noticed = any(p in low for p in NOTICES) or any(p in low for p in TOPICS)
    found = [line_fault(line, noticed) if line.strip() else None for line in lines]
    if len(lines) >= MENU_LINES:
        mark_menus(lines, found)
    for line, fault in zip(lines, found):
        full = not not line.strip()
        if full:
            if line in seen:
                dup += 1
            seen.add(line)
        rest = b"" if fault else without_notices(line) if noticed and full else line
        if len(rest) != len(line):
            lost += len(line.split()) - len(rest.split())
            faults[fault or "boilerplate"] += 1
        if not fault and (rest.strip() or not full):
            kept.append(rest)
    n = len(words)
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
    return {
        "n_words": n,
        "word_chars": len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))),
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeat,
        "lost_words": lost,
        "faults": ",".join(f"{k}:{v}" for k, v in sorted(faults.items())),
        "base_failed": failed,
        "kept": not failed and lost <= max_loss * n,
        "clean_text": (b"\n".join(kept) if lost else raw).decode("utf-8", "surrogatepass"),
    }


def quality_rules(docs: DataFrame, max_loss: float = MAX_LOSS, carry: tuple[str, ...] = ("doc_id",), with_text: bool = True) -> DataFrame:
    """``carry`` columns of every document, the base counts, ``lost_words``, ``faults`` (removed lines by
    rule), ``base_failed``, ``kept`` and, if asked for, ``clean_text`` (the text without removed lines)."""
    fields = [(k, pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words")]
    fields += [("faults", pa.string()), ("base_failed", pa.bool_()), ("kept", pa.bool_())] + [("clean_text", pa.string())] * with_text

    def make():
        def go(texts: list[str]) -> dict[str, list]:
            got = [judge(t, max_loss) for t in texts]
            return {k: [g[k] for g in got] for k, _ in fields}

        return go

    return map_texts(docs.select(*carry, F.col("text").cast("string").alias("judged_text")), make, fields, "judged_text")


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words", "faults")
