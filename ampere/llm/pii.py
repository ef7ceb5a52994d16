"""Personal data replaced by surrogates of the same kind.

Detected are e-mail addresses, IPv4 addresses, payment card numbers (those
whose Luhn sum holds), phone numbers, IBANs, access keys, passwords and tokens
after their label, and names after a title or an introduction, before a title that
follows, or beginning with a common given name. Each gets a keyed surrogate
that keeps its kind and format: separators, letter case, lengths, country
codes, a valid Luhn sum, a valid IBAN remainder, the gender of titles and given
names, and the script of names. Only IBANs whose remainder holds are found.

An entity's *canonical form* drops what writing it differently changes (case,
separators, title). A surrogate belongs to the canonical form in the whole
corpus, so mentions that refer to the same entity still do. Two entities with
one surrogate, or a surrogate that occurs as an entity, are found by an
aggregate over the distinct forms and drawn again until none is left; from the
third draw on a surrogate is longer than its form, so that a free one exists.

A text is cut at its mentions once, and the pieces are written to the shared
folder; all later steps read those. Only SQL functions run on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.base import materialize
from ampere.llm.substring import keyed_columns

KEY = "ampere"

#: Titles, introductions and given names by gender and script: fixed lists.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "Κύριος", "Κος", "السيد"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "Κυρία", "Κα", "السيدة"],
    "n": ["Dr", "Prof", "my name is", "My name is", "name:", "Name:"],
}
#: Titles that follow a name.
AFTER = {"m": ["先生"], "f": ["女士", "小姐"], "n": ["さん", "様", "씨", "님"]}
GIVEN = {
    "m": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Klaus", "Pierre", "Jean", "Carlos", "José", "Иван", "Пётр", "Сергей", "Алексей"],
    "f": ["Mary", "Anna", "Linda", "Susan", "Sarah", "Emma", "Laura", "Julia", "Ursula", "Sabine", "Marie", "Claire", "Carmen", "Lucía", "Мария", "Ольга", "Елена", "Наталья"],
}
#: Scripts of names; any other counts as Latin.
SCRIPTS = {"c": "Cyrillic", "g": "Greek", "j": "Hiragana", "J": "Katakana", "h": "Han", "k": "Hangul", "a": "Arabic", "e": "Hebrew", "d": "Devanagari", "t": "Thai"}
NEW_GIVEN = {
    "lm": ["Adam", "Bruno", "Cyril", "Dario", "Edgar", "Felix", "Gustav", "Henrik", "Ivo", "Jonas", "Kilian", "Lorenz", "Marius", "Nils", "Oskar", "Quentin"],
    "lf": ["Alma", "Beata", "Celia", "Dora", "Edith", "Flora", "Greta", "Hanna", "Irene", "Jana", "Kira", "Lydia", "Mona", "Nora", "Olivia", "Paula"],
    "ln": ["Alex", "Robin", "Kim", "Sasha", "Toni", "Noa", "Charlie", "Jules"],
    "cm": ["Антон", "Борис", "Глеб", "Денис", "Егор", "Захар", "Марк", "Тимур"],
    "cf": ["Алла", "Вера", "Дарья", "Зоя", "Инна", "Кира", "Нина", "Рита"],
    "cn": ["Саша", "Женя", "Валя", "Слава"],
    "gm": ["Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Λεωνίδας", "Πέτρος", "Σταύρος", "Φώτης"],
    "gf": ["Αθηνά", "Βασιλική", "Δήμητρα", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Χρυσή"],
    "am": ["أحمد", "بلال", "خالد", "سامي", "طارق", "عمر", "كريم", "ياسر"],
    "af": ["أمل", "دينا", "رنا", "سلمى", "فاطمة", "ليلى", "مريم", "هدى"],
}
#: What new names are made of, where no list has them; 16 of each script.
SYLLABLES = {
    "l": ["ba", "do", "fe", "gi", "ha", "ke", "li", "mo", "na", "pe", "ro", "sa", "ti", "vu", "wo", "za"],
    "c": ["ба", "до", "фе", "ги", "ха", "ке", "ли", "мо", "на", "пе", "ро", "са", "ти", "ву", "жо", "за"],
    "g": ["βα", "δο", "φε", "γι", "χα", "κε", "λι", "μο", "να", "πε", "ρο", "σα", "τι", "βυ", "ζο", "ξα"],
    "h": list("王李张刘陈杨赵黄周吴徐孙胡朱高林"),
    "j": list("あかさたなはまやらわきしちにみり"),
    "J": list("アカサタナハマヤラワキシチニミリ"),
    "k": list("김이박최정강조윤장임한오서신권황"),
    "a": ["با", "دو", "في", "جي", "حا", "كي", "لي", "مو", "نا", "بي", "رو", "سا", "تي", "فو", "وا", "زا"],
    "e": ["בא", "דו", "פה", "גי", "חא", "קה", "לי", "מו", "נא", "פי", "רו", "סא", "טי", "וו", "זא", "שי"],
    "d": ["बा", "दो", "फे", "गी", "हा", "के", "ली", "मो", "ना", "पे", "रो", "सा", "ती", "वू", "जा", "शी"],
    "t": ["บา", "ดา", "ฟา", "กา", "หา", "คา", "ลา", "มา", "นา", "ปา", "รา", "สา", "ตา", "วา", "ยา", "ชา"],
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_AFTER = "|".join(t for ts in AFTER.values() for t in ts)
_GIVEN = "|".join(sorted((t for ts in GIVEN.values() for t in ts), key=len, reverse=True))
#: A part of a name: capitalised, or a few letters of a script without case.
_UNCASED = "|".join(rf"\p{{Is{SCRIPTS[s]}}}{{{n}}}" for s, n in (("h", "1,4"), ("j", "2,8"), ("J", "2,8"), ("k", "2,4"), ("a", "2,20"), ("e", "2,20"), ("d", "2,20"), ("t", "2,20")))
_NAME = rf"(?:\p{{Lu}}\p{{Ll}}[\p{{L}}'’-]*|{_UNCASED})"
_LABEL = r"\b(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}\"?"
#: Kinds in the order in which a mention is tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}",
    "secret": _LABEL + r"(?=[^A-Za-z0-9\s\"',;]*+[A-Za-z0-9])[!-~&&[^\"',;<>`]]{7,}[A-Za-z0-9+/_!#$%&*=@^~-]",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "card": r"(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME}|(?:{_UNCASED})(?: ?{_UNCASED})? ?(?:{_AFTER}))",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(xs: list[str]) -> str:
    return "array({})".format(", ".join(_sql(x) for x in xs))


#: Stands between a text and its mentions: a code point that no character has.
MARK = "\ufdd0"


def cut(text: Column) -> Column:
    """The pieces of a text: its plain parts (even places, maybe empty) and the
    mentions between them (odd places), which together are the text."""
    marked = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    each = F.zip_with(F.split(text, ANY, -1), found, lambda p, m: F.when(m.isNull(), F.array(p)).otherwise(F.array(p, m)))
    return F.when(F.contains(text, F.lit(MARK)), F.flatten(each)).otherwise(marked)


def kind_of(mention: str) -> str:
    """SQL: a mention's kind; null for a number without a Luhn sum and for an
    IBAN whose remainder does not hold."""
    holds = {"card": f"{luhn(_digits(mention))} = 0", "iban": f"{remainder(_rearranged(_joined(mention)))} = 1"}
    out = "CASE"
    for kind, p in PATTERNS.items():
        test = f"{mention} RLIKE {_sql('^(?:' + p + ')$')}"
        out += f" WHEN {test} THEN " + (f"IF({holds[kind]}, '{kind}', NULL)" if kind in holds else f"'{kind}'")
    return out + " END"


def _joined(iban: str) -> str:
    return f"replace({iban}, ' ', '')"


def _rearranged(iban: str) -> str:
    return f"concat(substring({iban}, 5), substring({iban}, 1, 4))"


def remainder(s: str) -> str:
    """SQL: a string of digits and letters (A is 10) modulo 97."""
    value = "conv(x, 36, 10)"
    return f"aggregate(split({s}, ''), 0, (a, x) -> cast((a * IF(x RLIKE '[0-9]', 10, 100) + cast({value} as int)) % 97 as int))"


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: the Luhn sum of a digit string, modulo 10."""
    double = "IF(cast(d as int) > 4, 2 * cast(d as int) - 9, 2 * cast(d as int))"
    each = f"transform(split(reverse({digits}), ''), (d, i) -> IF(i % 2 = 1, {double}, cast(d as int)))"
    return f"aggregate({each}, 0, (a, x) -> (a + x) % 10)"


def card_in(m: str) -> str:
    """SQL: where in a mention of digit groups a number with a Luhn sum is,
    ``struct<a, e>`` of its first and last character, or null: the whole, else
    one of 16 digits, else the first and longest."""
    apart = f"filter(sequence(1, length({m})), i -> substring({m}, i, 1) IN (' ', '-'))"
    ends = f"concat(transform({apart}, i -> i - 1), array(length({m})))"
    pairs = f"flatten(transform(concat(array(1), transform({apart}, i -> i + 1)), b -> transform({ends}, e -> named_struct('a', b, 'e', e))))"
    part = _digits(f"substring({m}, u.a, u.e - u.a + 1)")
    good = f"filter({pairs}, u -> u.e > u.a AND length({part}) BETWEEN 13 AND 19 AND {luhn(part)} = 0)"
    rank = f"IF(u.e - u.a + 1 = length({m}), 2, IF(length({part}) = 16, 1, 0))"
    best = f"array_max(transform({good}, u -> named_struct('r', {rank}, 'b', -u.a, 'e', u.e)))"
    return f"transform(array({best}), v -> IF(v IS NULL, NULL, named_struct('a', -v.b, 'e', v.e)))[0]"


def _secret_value(m: str) -> str:
    return f"regexp_replace({m}, {_sql('^(?:' + _LABEL + ')')}, '')"


def gender(m: str) -> str:
    out = "CASE"
    for g in "mfn":
        first = [*TITLES[g], *GIVEN.get(g, [])]
        out += f" WHEN {m} RLIKE {_sql('^(?:' + '|'.join(first) + ')' + chr(92) + '.? |(?:' + '|'.join(AFTER[g]) + ')$')} THEN '{g}'"
    return out + " ELSE 'n' END"


def _script(m: str) -> str:
    out = "CASE"
    for code, name in SCRIPTS.items():
        out += f" WHEN {m} RLIKE {_sql(chr(92) + 'p{Is' + name + '}')} THEN '{code}'"
    return out + " ELSE 'l' END"


def _untitled(m: str) -> str:
    """SQL: a name without the title before it or after it."""
    before = f"regexp_replace({m}, {_sql('^(?:' + _TITLE + ')' + chr(92) + '.? ')}, '')"
    return f"regexp_replace({before}, {_sql(' ?(?:' + _AFTER + ')$')}, '')"


def canonical(kind: str, m: str) -> str:
    """SQL: what all mentions of one entity have in common."""
    return (
        f"CASE {kind} WHEN 'email' THEN lower({m}) WHEN 'phone' THEN {_digits(m)} WHEN 'card' THEN {_digits(m)} "
        f"WHEN 'iban' THEN replace({m}, ' ', '') WHEN 'secret' THEN {_secret_value(m)} "
        f"WHEN 'name' THEN concat({_script(_untitled(m))}, {gender(m)}, ' ', {_untitled(m)}) ELSE {m} END"
    )


def _stream(*parts: str) -> str:
    """SQL: 128 hex digits that depend on the key and the parts."""
    joined = ", '|', ".join(parts)
    return "concat({}, {})".format(*(f"sha2(concat('{i}|', __key, '|', {joined}), 256)" for i in (0, 1)))


def _byte(h: str, i: str) -> str:
    return f"cast(conv(substring({h}, 1 + 2 * cast(pmod({i}, 64) as int), 2), 16, 10) as int)"


def _shaped(s: str, h: str, letters: int = 26) -> str:
    """SQL: ``s`` with its digits, small and capital letters drawn anew."""
    b = _byte(h, "i")
    return (
        f"array_join(transform(split({s}, ''), (c, i) -> CASE WHEN c RLIKE '[0-9]' THEN cast({b} % 10 as string) "
        f"WHEN c RLIKE '[a-z]' THEN chr(97 + {b} % {letters}) WHEN c RLIKE '[A-Z]' THEN chr(65 + {b} % {letters}) ELSE c END), '')"
    )


def surrogate(kind: str, c: str, attempt: str, surname: str) -> str:
    """SQL: the surrogate of a canonical form, drawn for the ``attempt``-th time.
    A name of several parts has ``surname`` after a given name of its gender,
    which is compound from the third draw on."""
    h = _stream(kind, c, f"cast({attempt} as string)")
    more = f"IF({attempt} < 2, '', substring({_stream(_sql('more'), kind, c, f'cast({attempt} as string)')}, 1, cast({attempt} as int) - 1))"
    digits = f"translate({more}, 'abcdef', '012345')"
    domain = f"substring_index({c}, '@', -1)"
    label = f"regexp_replace({domain}, '[.][^.]*$', '')"
    email = (
        f"concat({_shaped(f'substring_index({c}, {_sql(chr(64))}, 1)', h)}, {more}, '@', {_shaped(label, _stream(_sql('domain'), domain))}, "
        f"'.', substring_index({domain}, '.', -1))"
    )
    # private addresses, then reserved ones
    ip = f"concat(IF({attempt} < 4, 10, 240 + {_byte(h, '3')} % 15), '.', {_byte(h, '0')}, '.', {_byte(h, '1')}, '.', {_byte(h, '2')})"
    body = f"concat(substring({c}, 1, 1), {_shaped(f'substring({c}, 2, length({c}) - 2)', h)})"
    card = f"transform(array({body}), y -> concat(y, cast((10 - {luhn('concat(y, {0})'.format(_sql('0')))}) % 10 as string)))[0]"
    phone = f"concat(substring({c}, 1, greatest(1, length({c}) - 9)), {_shaped(f'substring({c}, greatest(1, length({c}) - 9) + 1)', h)}, {digits})"
    account = f"concat({_shaped(f'substring({c}, 5)', h)}, {digits})"
    check = f"lpad(cast(98 - {remainder(f'concat(y, substring({c}, 1, 2), {_sql(str(0) * 2)})')} as string), 2, '0')"
    iban = f"transform(array({account}), y -> concat(substring({c}, 1, 2), {check}, y))[0]"
    secret = f"concat(IF({c} RLIKE '^[0-9a-f]+$', {_shaped(c, h, 6)}, {_shaped(c, h)}), {more})"
    pick = f"CASE substring({c}, 1, 1)" + "".join(f" WHEN '{k}' THEN {_list(v)}" for k, v in SYLLABLES.items()) + " END"
    short = f"IF(substring({c}, 1, 1) IN ('h', 'k'), 1, 2)"  # a syllable of these is as much as two letters

    def made(more: str, byte: str) -> str:
        return f"initcap(array_join(transform(sequence(0, {more}), i -> element_at({pick}, 1 + {_byte(h, byte)} % 16)), ''))"

    last = made(f"{short} + cast({attempt} as int)", "i")
    given = f"CASE substring({c}, 1, 2)"
    for k, names in NEW_GIVEN.items():
        each = f"{_list(names)}[{_byte(h, '63 - i')} % {len(names)}]"
        given += f" WHEN '{k}' THEN array_join(transform(sequence(0, cast({attempt} as int) div 2), i -> {each}), '-')"
    given += f" ELSE {made(f'1 + cast({attempt} as int) div 2', '63 - i')}"
    name = f"concat({given} END, ' ', {surname})"
    key = f"concat('AKIA', {_shaped(f'substring({c}, 5)', h)})"
    return (
        f"CASE {kind} WHEN 'email' THEN {email} WHEN 'ip' THEN {ip} WHEN 'card' THEN {card} WHEN 'phone' THEN {phone} "
        f"WHEN 'iban' THEN {iban} WHEN 'secret' THEN {secret} WHEN 'key' THEN {key} WHEN 'surname' THEN {last} ELSE {name} END"
    )


def as_written(kind: str, m: str, s: str) -> str:
    """SQL: a surrogate in the writing of a mention: its separators, case,
    label or title."""
    fill = (
        f"aggregate(split({m}, ''), named_struct('t', '', 'i', 0), (a, x) -> IF(x RLIKE '[A-Za-z0-9]', "
        f"named_struct('t', concat(a.t, substring({s}, a.i + 1, 1)), 'i', a.i + 1), named_struct('t', concat(a.t, x), 'i', a.i)), a -> concat(a.t, substring({s}, a.i + 1)))"
    )
    before = f"substring({m}, 1, char_length({m}) - char_length({_secret_value(m)}))"
    title = f"regexp_extract({m}, {_sql('^(?:' + _TITLE + ')' + chr(92) + '.? ')}, 0)"
    after = f"regexp_extract({m}, {_sql(' ?(?:' + _AFTER + ')$')}, 0)"
    return (
        f"CASE WHEN {kind} = 'email' AND {m} = upper({m}) THEN upper({s}) WHEN {kind} IN ('phone', 'card', 'iban') THEN {fill} "
        f"WHEN {kind} = 'secret' THEN concat({before}, {s}) WHEN {kind} = 'name' THEN concat({title}, {s}, {after}) ELSE {s} END"
    )


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, form, surrogate)`` for each distinct ``(kind, form)``: within a
    kind no two forms share a surrogate, and none is itself a form. A last name
    has one surrogate per script, whatever title or given name is before it; a
    name without a given name is that surname alone, under its own title."""
    forms = materialize(entities.select("kind", "form").distinct(), "forms")
    last = F.concat(F.substring("form", 1, 1), F.lit(" "), F.substring_index("form", " ", -1))
    names = forms.where("kind = 'name'").withColumn("last", last)
    lasts = names.select(F.lit("surname").alias("kind"), F.col("last").alias("form")).distinct()
    none = F.lit(None).cast("string").alias("surname")
    told = drawn(forms.where("kind <> 'name'").unionByName(lasts).select("kind", "form", none), key)
    surnames = told.where("kind = 'surname'").select(F.col("form").alias("last"), F.col("surrogate").alias("surname"))
    names = names.join(surnames, "last").select("kind", "form", "surname")
    given = F.size(F.split("form", " ")) > 2
    alone = names.where(~given).select("kind", "form", F.col("surname").alias("surrogate"))
    return told.where("kind <> 'surname'").unionByName(alone).unionByName(drawn(names.where(given), key))


def drawn(forms: DataFrame, key: str) -> DataFrame:
    """``(kind, form, surrogate)`` for distinct ``(kind, form, surname)``, drawn
    until within a kind no two share a surrogate and none is itself a form."""
    drawn = materialize(forms.withColumn("attempt", F.lit(0)), "forms")
    clash = None
    while clash is None or not clash.isEmpty():
        if clash is not None:
            again = clash.withColumn("again", F.lit(1))
            drawn = drawn.join(again, ["kind", "form"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
        s = drawn.select("kind", "form", "surname", "attempt").withColumn("__key", F.lit(key))
        drawn = materialize(s.withColumn("surrogate", F.expr(surrogate("kind", "form", "attempt", "surname"))).drop("__key"), "drawn")
        # names are compared without script and gender, as they would be read
        read = F.when(F.col("kind") == "name", F.expr("substring(form, 4)")).when(F.col("kind") == "surname", F.expr("substring(form, 3)"))
        read = read.otherwise(F.col("form"))
        uses = drawn.select("kind", "form", F.col("surrogate").alias("s"), F.lit(False).alias("real")).unionByName(
            drawn.select("kind", "form", read.alias("s"), F.lit(True).alias("real"))
        )
        taken = uses.groupBy("kind", "s").agg(
            F.max("real").alias("real"), F.min(F.when(~F.col("real"), F.col("form"))).alias("first"), F.count_if(~F.col("real")).alias("n")
        ).where("n > 1 or (n > 0 and real)")
        taken = taken.select("kind", F.col("s").alias("surrogate"), "real", "first")
        clash = drawn.join(taken, ["kind", "surrogate"]).where("real or form != first").select("kind", "form")
        clash = materialize(clash, "clash")
    return drawn.select("kind", "form", "surrogate")


def _put(s: Column) -> Column:
    return F.concat(s["before"], s["s"]["surrogate"], s["after"])


def replace_entities(docs: DataFrame, carry: list[str], key: str = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, text, entities)`` for each row: the carried columns, the text
    with surrogates, and ``array<struct<kind, surrogate>>`` in their order.

    Texts without an entity, null and empty ones are unchanged and are not
    shuffled. The mentions of a document are gathered per document, which
    bounds them by its length; a common entity's mentions meet its surrogate
    in a join that is split where it is skewed. Rows that agree in id and text
    are replaced alike.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry if c != text], F.lit(0).alias("__")).alias("row")
    base = docs.select(*keyed_columns(doc_id, text), carried)
    base = materialize(base.select("id", "key", "row", cut(F.col("text")).alias("parts")), "cut")
    found = F.filter("parts", lambda x, i: i % 2 == 1)
    some = base.where(F.size("parts") > 1)
    each = some.select("id", "key", F.explode(F.array_distinct(found)).alias("m")).distinct()
    digits = f"m RLIKE {_sql('^(?:' + PATTERNS['card'] + ')$')}"
    each = materialize(each.withColumn("at", F.expr(f"CASE WHEN {digits} THEN {card_in('m')} END")), "found")
    # a card number may have other numbers around it in its mention
    inner = F.coalesce(F.expr("substring(m, at.a, at.e - at.a + 1)"), F.col("m"))
    each = each.withColumn("before", F.coalesce(F.expr("substring(m, 1, at.a - 1)"), F.lit("")))
    each = each.withColumn("after", F.coalesce(F.expr("substring(m, at.e + 1)"), F.lit(""))).withColumn("inner", inner).drop("at")
    told = each.withColumn("kind", F.expr(kind_of("inner"))).where("kind is not null")
    told = materialize(told.withColumn("form", F.expr(canonical("kind", "inner"))), "mentions")
    drawn = materialize(surrogates(told, key), "surrogates")
    written = told.join(drawn, ["kind", "form"]).select(
        "id", "key", "m", "before", "after", F.struct("kind", F.expr(as_written("kind", "inner", "surrogate")).alias("surrogate")).alias("s")
    )
    maps = written.groupBy("id", "key").agg(F.map_from_entries(F.collect_list(F.struct("m", F.struct("before", "s", "after")))).alias("by"))
    none = F.expr("cast(array() as array<struct<kind:string,surrogate:string>>)")
    joined = some.join(maps, ["id", "key"], "left")
    new = F.transform("parts", lambda x, i: F.when(i % 2 == 1, F.coalesce(_put(F.try_element_at("by", x)), x)).otherwise(x))
    text_ = F.array_join(F.when(F.col("by").isNull(), F.col("parts")).otherwise(new), "")
    entities = F.coalesce(F.filter(F.transform(found, lambda m: F.try_element_at("by", m)["s"]), lambda s: s.isNotNull()), none)
    changed = joined.select("row", text_.alias("text"), entities.alias("entities"))
    rest = base.where("size(parts) = 1 or parts is null").select("row", F.col("parts")[0].alias("text"), none.alias("entities"))
    return rest.unionByName(changed)


def op10_pii_surrogates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text with surrogates, n_entities, entities."""
    out = replace_entities(docs, ["doc_id"])
    return out.select("row.doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts and n_chars to match."""
    out = replace_entities(docs, docs.columns)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        count = F.when(F.size("entities") > 0, F.char_length("text")).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = count.cast(docs.schema["n_chars"].dataType)
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
