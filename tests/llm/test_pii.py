"""Surrogates against a brute-force replacement, scripts beyond Latin, IBANs."""

import re

import pytest
import regex

from ampere.llm import pii

ANY = regex.compile(pii.ANY, regex.V1)


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, [(e.kind, e.surrogate) for e in r.entities]) for r in pii.op10_pii_surrogates(df).orderBy("doc_id").collect()]


def remainder(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_cut_equals_the_mentions(spark):
    texts = [
        "", "nothing", "a@b.cc", "a@b.cc c@d.ee", "x a@b.cc\ny 1.2.3.4. +1 555 123 4567 z", "1.2.3.4.5 1.2.3.4", f"{pii.MARK} a@b.cc {pii.MARK}c@d.ee{pii.MARK}", None,
        "Mr John Smith, password: hunter2!!x", "$0 \\1 ${name} a@b.cc $",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r.p for r in df.select("i", pii.cut(pii.F.col("text")).alias("p")).orderBy("i").collect()]
    for t, parts in zip(texts, got):
        if t is None:
            assert parts is None
            continue
        assert "".join(parts) == t and parts[1::2] == [m.group(0) for m in ANY.finditer(t)]


def test_replacement_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    out = {r.doc_id: r for r in pii.op10_pii_surrogates(docs).collect()}
    assert out.keys() == rows.keys()
    by_form, n = {}, 0
    for i, text in rows.items():
        entities = [(e.kind, e.surrogate) for e in out[i].entities]
        n += len(entities)
        # the text is the old one with every entity's mention, in order, replaced by its surrogate
        at, queue, built = 0, list(entities), []
        for m in ANY.finditer(text or ""):
            built.append(text[at : m.start()])
            at = m.end()
            kind = next((k for k, p in pii.PATTERNS.items() if regex.fullmatch(p, m.group(0), regex.V1)), None)
            digits = [int(c) for c in reversed(re.sub(r"\D", "", m.group(0)))]
            luhn = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
            if (kind == "card" and luhn % 10) or (kind == "iban" and remainder(m.group(0)) != 1):
                built.append(m.group(0))
                continue
            got = queue.pop(0)
            assert got[0] == kind
            built.append(got[1])
            form = m.group(0).lower() if kind == "email" else re.sub(r"\D", "", m.group(0)) if kind in ("phone", "card") else m.group(0)
            value = got[1].lower() if kind == "email" else re.sub(r"\D", "", got[1]) if kind in ("phone", "card") else got[1]
            assert by_form.setdefault((kind, form), value) == value  # one entity, one surrogate
        built.append((text or "")[at:])
        assert not queue and out[i].text == (None if text is None else "".join(built))
    assert n > 20 and len(set(by_form.values())) == len(by_form)
    assert not {f for _, f in by_form} & set(by_form.values())


@pytest.mark.parametrize(
    "text, script",
    [
        ("Mr Νίκος Παπάς wrote", "Greek"), ("Κα Ελένη Δούκα wrote", "Greek"), ("Dr 張偉 wrote", "Han"), ("我们请 王芳女士 wrote", "Han"), ("Mr محمد علي wrote", "Arabic"),
        ("السيد خالد wrote", "Arabic"), ("г-жа Анна Петрова wrote", "Cyrillic"), ("たなか さん wrote", "Hiragana"), ("김민수 씨 wrote", "Hangul"), ("Dr Smith wrote", "Latin"),
        ("г-н Smith wrote", "Latin"), ("My name is Anke Meyer wrote", "Latin"), ("Dr כהן wrote", "Hebrew"),
    ],
)
def test_names_keep_their_script(spark, text, script):
    (new, entities), (again, _) = replaced(spark, [text, "x " + text])
    assert [k for k, _ in entities] == ["name"] and new != text and new.endswith(" wrote") and again == "x " + new
    title = regex.match(rf"(?:{pii._TITLE})\.? ", text)
    old = text[title.end() :] if title else text
    fresh = new[title.end() :] if title else new
    assert new.startswith(title.group(0) if title else "")
    old, fresh = (regex.sub(rf" ?(?:{pii._AFTER})(?= wrote)", "", x).removesuffix(" wrote") for x in (old, fresh))
    old, fresh = old.removeprefix("我们请 "), fresh.removeprefix("我们请 ")
    assert old != fresh and regex.fullmatch(rf"[\p{{{script}}} -]+", fresh) and not set(old.split()) & set(fresh.split())


def test_gender_of_new_scripts(spark):
    got = [t for t, _ in replaced(spark, ["Κος Νίκος Παπάς", "Κα Μαρία Παπά", "السيدة فاطمة علي"])]
    assert got[0].split()[1].split("-")[0] in pii.NEW_GIVEN["gm"] and got[1].split()[1].split("-")[0] in pii.NEW_GIVEN["gf"]
    assert got[2].split()[1].split("-")[0] in pii.NEW_GIVEN["af"]


def test_ibans(spark):
    texts = ["AB12 CDEF GHIJ", "pay GB82 WEST 1234 5698 7654 32 now", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00"]
    got = replaced(spark, texts)
    assert got[0] == (texts[0], [])
    new = got[1][0][4:-4]
    assert re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", new) and remainder(new) == 1 and new != "GB82 WEST 1234 5698 7654 32"
    assert got[2][0] == new.replace(" ", "")
    first, second = got[3][0].split(" and ")
    assert remainder(first) == 1 and first.startswith("DE") and second == "DE88 3704 0044 0532 0130 00"


def test_secrets_with_any_mark(spark):
    texts = ["password: hunter2!!secretword.", 'token = "a1b2c3d4e5f6a7b8"', "pwd=__________", "secret: Ab1$cd2%ef3&x", "password: short1"]
    got = replaced(spark, texts)
    assert re.fullmatch(r"password: [a-z]{6}\d!!secretword\.|password: [a-z]{6}\d!![a-z]{10}\.", got[0][0]) and "hunter2" not in got[0][0]
    assert re.fullmatch(r'token = "[0-9a-f]{16}"', got[1][0]) and got[1][0] != texts[1]
    assert got[2] == (texts[2], []) and got[4] == (texts[4], [])
    assert [k for k, _ in got[3][1]] == ["secret"] and re.fullmatch(r"secret: [A-Z][a-z]\d\$[a-z]{2}\d%[a-z]{2}\d&[a-z]", got[3][0])


def test_addresses_are_never_public(spark):
    forms = spark.createDataFrame([("ip", f"9.{a}.{b}.{c}") for a in range(2) for b in range(30) for c in range(30)], "kind string, form string")
    drawn = forms.withColumn("__key", pii.F.lit("k"))
    for attempt in (0, 3, 4, 9):
        new = drawn.selectExpr(f"{pii.surrogate('kind', 'form', str(attempt), repr('x'))} AS s").collect()
        assert all(r.s.startswith("10.") if attempt < 4 else 240 <= int(r.s.split(".")[0]) <= 254 for r in new)


def test_long_domains_and_long_texts(spark):
    many = "a@" + "x." * 12 + "com"
    long = "word " * 450_000 + "mail me@here.org " + "word " * 10
    got = replaced(spark, [many, long, None, ""])
    assert [k for k, _ in got[0][1]] == ["email"] and got[0][0].count(".") == 12
    assert len(long) > 2 << 20 and got[1][0].startswith("word " * 450_000 + "mail ") and "me@here.org" not in got[1][0]
    assert got[2] == (None, []) and got[3] == ("", [])


def test_stage_without_n_chars(spark):
    df = spark.createDataFrame([(1, "me@here.org", 7), (2, None, 8)], "doc_id long, text string, parts int")
    rows = {r.doc_id: r for r in pii.stage(spark, df, "").collect()}
    assert rows[1].parts == 7 and rows[1].text != "me@here.org" and rows[2].text is None and list(rows[1].asDict()) == df.columns
