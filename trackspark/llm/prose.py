"""English running prose out of pages, docstrings and comments.

Pure functions over one text, called in Arrow batches. A line is prose if, apart from comment
marks and bullets, it holds words and ordinary punctuation only; code, tables and data do not look
like that whatever the file is called. Neighbouring prose lines form a block, and blocks that are
legal notices, in another language or too short to be running text are left out. Each block is
judged by its own words, wherever it lies and however long the text is.

A file is generated if a comment before its first other line says so, however long that comment is;
elsewhere only the comment line with such a notice is no prose, and in a page's sentence the words
mean nothing special.
"""

from __future__ import annotations

import re

#: A run of prose with fewer words is a label or a remark.
LEAST_RUN = 8

# characters of code and tables
_PLAIN = re.compile(r"[^{}\[\]=<>|\\$@^~%_]*")
# a call, an attribute, a statement's end, a key
_CODEY = re.compile(r"[A-Za-z]\w*\(|[a-z]\.[a-z]\w|;\s*$|^\S+(?:\s\S+){0,2}:\s*$|^\S+:\s+\S+\s*$")
_STATEMENT = re.compile(r"(?:return|import|from|except|raise|yield|assert|package|use|using|include|else|elif|insert into|select|left join|where|group by|create)\b")
_ITEM = re.compile(r"\d{1,3}[.)][ \t]+")
#: No word is this long; keys, digests and links are, and count as a stop inside their line.
_LONG = re.compile(r"\S{40,}")
_TAG = re.compile(r"<(style|script|title|h\d)\b[^>]*>.*?(?:</\1>|$)|<[^<>\n]*>", re.S | re.I)
# letters next to digits are names and keys
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:['’][^\W\d_]+)*(?!\w)")
_QUOTED = re.compile(r"`[^`\n]*`|\(see [^()\n]*\)")
_GENERATED = re.compile(r"auto-?generated|code generated|generated by|do not edit", re.I)
_COMMENT = re.compile(r"[ \t]*(?://|#|/\*|\*|--|<!--|;|%)")
_EDGE = " \t/*#-!>;'\"“‘("
# stems that in one block make it a legal notice, two different ones at least
_LEGAL = re.compile(r"\b(licen[cs]|terms?\b|warrant|permission|copyright|liab|redistribut|recipient|endors|grant|holders\b|shall\b|notice\b|maintainers\b|spdx|rights?\b)", re.I)

# fixed values: frequent function words
_EN = frozenset("the a an and or of to in is it that for on with as by at be are was were this which from not you your we they he she its their has have had but if then than when who will can may so no do does there one more each".split())
_OTHER = frozenset(
    (
        "der die das und ist nicht ein eine einer eines einem einen zu im mit auf für von den dem des sich wird wurde werden sind oder aber auch beim nach vor ob sie ohne seine jeder "
        "el la los las un una unos unas de del que y en es se por para con su al lo como si no pero más después antes cada tiene "
        "le les des du et est dans pour que qui une sur au aux ne pas par avec son sa ses cette ce ces il elle sont avant après chaque plus"
    ).split()
) - frozenset("no an in on me so more plus".split())


def generated(text: str) -> bool:
    """True if a comment at the head of a file, before any other line, says that a program wrote it."""
    at, inside = 0, False
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        mark = _COMMENT.match(text, at, end)
        if mark or inside:
            if _GENERATED.search(text, at, end):
                return True
            if mark and mark[0].lstrip() in ("/*", "<!--"):
                inside = True
            if text.find("*/", at, end) >= 0 or text.find("-->", at, end) >= 0:
                inside = False
        elif text[at:end].strip():
            return False
        at = end + 1
    return False


def _runs(text: str) -> list[list[str]]:
    """Runs of neighbouring prose paragraphs; only blank lines lie between those of one run."""
    runs: list[list[str]] = []
    run: list[str] = []
    para: list[str] = []
    plain = _PLAIN.fullmatch
    for line in text.split("\n"):
        s = line.lstrip(_EDGE)
        if not s or s.isspace():
            if para:
                run.append(" ".join(para))
                para = []
            continue
        if s[0].isdigit() and (m := _ITEM.match(s)):
            s = s[m.end() :]
        if len(s) >= 40 and _LONG.search(s):
            s = _LONG.sub(" ", s).lstrip(_EDGE)
        good = (s[:1].isalpha() or para) and plain(s)
        if good and not (_CODEY.search(s) or (len(s) < 60 and _STATEMENT.match(s)) or (_COMMENT.match(line) and _GENERATED.search(s))):
            if line[:1] == "#" and para and line[:2] == "##":
                run.append(" ".join(para))
                para = []
            para.append(s)
            continue
        if para:
            run.append(" ".join(para))
            para = []
        if run:
            runs.append(run)
            run = []
    if para:
        run.append(" ".join(para))
    if run:
        runs.append(run)
    return runs


def blocks(text: str) -> list[list[str]]:
    """Lower-case words of each paragraph of English prose."""
    if not text or generated(text):
        return []
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "<p>" in text or "<html" in text:
        text = _TAG.sub("\n\n", text)
    if "`" in text or "(see " in text:
        text = _QUOTED.sub("", text)
    found: list[list[str]] = []
    for run in _runs(text):
        mine, size, legal, notices = [], 0, 0, 0
        for body in run:
            words = [w.lower() for w in _WORD.findall(body)]
            if len(words) < 3 or sum(map(len, words)) < 0.72 * (len(body) - body.count(" ")):
                continue
            if len({m.lower() for m in _LEGAL.findall(body)}) >= 2:
                legal += len(words)
                notices += 1
                continue
            en = sum(w in _EN for w in words)
            foreign = sum(w in _OTHER or not w.isascii() for w in words)
            if foreign > en:
                continue
            mine.append(words)
            size += len(words)
        # one legal paragraph is a notice; the other clauses of a run of several are no prose either
        if size >= LEAST_RUN and (size >= legal or notices < 2):
            found += mine
    return found


def words(text: str) -> list[str]:
    """Words of all English prose in a text."""
    return [w for b in blocks(text) for w in b]
