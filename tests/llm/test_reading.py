"""Prose extraction and reading bands."""

import random

from trackspark.llm import prose, reading

SENT = "The quick lamp is on the table, and it was put there by the man who has a red hat"


def _n(text):
    return len(prose.words(text))


def test_prose_in_pages_docstrings_and_comments():
    n = len(SENT.split())
    assert _n(SENT + ".") == n
    assert _n("// " + SENT[:35] + "\n// " + SENT[36:] + ".\nint x = f(3);\n") == n
    assert _n('"""' + SENT + '.\n"""\nimport os\nimport sys\n') == n
    assert _n("/**\r\n * " + SENT + ".\r\n */\r\npackage core\r\n") == n
    assert _n("<html><head><style>p{margin:8px}</style></head><body><h1>a-b</h1>\n<p>" + SENT + ".</p></body></html>") == n
    assert _n("1. " + SENT + "\n2. " + SENT + "\n") == 2 * n
    assert _n("* " + SENT + ", e.g. in `conf.d/a_b.cfg`\n") in (n, n + 1, n + 2, n + 3)


def test_what_is_no_prose():
    assert _n(None) == 0 and _n("") == 0 and _n("   \n\n") == 0
    assert _n("// Code generated by x. DO NOT EDIT.\n// " + SENT) == 0
    assert _n("def f(self, key):\n    try:\n        return self._a[key]\n    except KeyError:\n        return None if self.b else 3\n" * 40) == 0
    assert _n('{"a": "' + SENT + '"}\n' * 9) == 0
    assert _n("id,t_s,x,y\n" + "0,0.1,0.2,0.3\n" * 99) == 0
    assert _n("# Distributed under the Zed terms; see the file COPYING that\n# accompanies this copy for the permissions granted and the limits of any\n# warranty.\n") == 0
    assert _n("Das Werkzeug schreibt seine Ausgabe in eine neue Datei und die Liste wird beim Start gelesen.\n" * 5) == 0
    assert _n("La tabla se carga al inicio y no cambia después, el programa avisa y sigue con el siguiente.\n" * 5) == 0
    assert _n("-----BEGIN KEY-----\n" + "Ab3+" * 16 + "\n" + "-----END KEY-----\n") == 0
    assert _n("insert into a_b (x, y)\nselect s.x, s.y from t s\n" * 30) == 0
    assert _n("x" * 300_000) == 0


def test_a_notice_counts_where_it_is_one():
    n, long = len(SENT.split()), (SENT + ".\n") * 6
    assert _n("The chart below was generated by the class in May.\n" + long) == 6 * n + 10
    assert _n(long + "The chart was generated by the class.\n") == 6 * n + 7
    assert _n("def f():\n    pass\n\n# " + SENT + "\n\n# do not edit below this line\n") == n
    header = "".join(f"// line {k} of a header that is long\n" for k in range(90))
    assert _n(header + "// Code generated by x. DO NOT EDIT.\npackage a\n// " + SENT) == 0
    assert _n("/*\nlong header\nAuto-generated by x\n*/\n// " + SENT) == 0
    assert _n("See https://example.org/" + "a" * 60 + " for more. " + SENT + ".") == n + 3
    assert _n("x" * 50) == 0 and _n("AB3CD9 ef81 " * 30) == 0


def test_legal_blocks_leave_other_blocks_alone():
    n = len(SENT.split())
    legal = "Permission is granted to all holders of a copy, and the warranty terms of this licence shall apply to it."
    other = "The name of the work is kept as it was in each of the parts of it that are sent on."
    assert _n("# " + legal + "\n\n# " + SENT + "\n") == n
    assert _n((legal + "\n\n") * 3 + other) == 0
    assert _n((legal + "\n\n") * 3 + "x = f(3);\n" + (SENT + ". ") * 2) == 2 * n


EASY = "cat dog ball hat red sun run sit".split()
MID = "server request folder pattern session option record column".split()
HARD = "epistemological reconciliation notwithstanding heterogeneity idempotency ambiguity asymptotic commutative".split()


def _doc(rnd, vocab, n=60):
    return " ".join(rnd.choice(vocab) if rnd.random() < 0.5 else rnd.choice("the is of and to it".split()) for _ in range(n)) + "."


def test_levels_held_out(spark):
    rnd = random.Random(8)
    rows, truth = [], {}
    for i in range(240):
        b = i % 3
        rows.append((i, _doc(rnd, (EASY, MID, HARD)[b]), "clash"))
        truth[i] = reading.BANDS[b]
    rows += [(1000, None, ""), (1001, "", ""), (1002, "Only a few words of the text are here.", ""), (1003, "int main(void) { return 0; }\n" * 200, ""), (5, rows[5][1], "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band string")
    votes = [(i, f"r{k}", truth[i] if rnd.random() < 0.9 else rnd.choice(reading.BANDS), "t") for i in range(90) for k in range(2)]
    votes += votes[:5] + [(None, "r", "secondary", "t"), (3, "r9", None, "t"), (4, "r9", "unknown", "t"), (99999, "r", "advanced", "t")]
    labels = spark.createDataFrame(votes, "doc_id long, rater string, band string, text string")
    got = reading.levels(docs, reading.fit(docs, labels)).collect()
    assert len(got) == 241 and {r.doc_id for r in got} == set(truth)
    held = [r for r in got if r.doc_id >= 90]
    assert sum(r.band == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert reading.fit(docs, labels.limit(0)) is None
    assert reading.levels(docs, None).count() == 0
