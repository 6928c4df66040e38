"""PII surrogates: keyed, type-consistent replacements, by DataFrame functions only.

Entities are found by one pattern. Each has units (an address, a number, the words of a name), and each unit a surrogate
that a keyed hash gives, so that a unit has the same surrogate wherever it occurs. Distinct units are compared over the
whole table: surrogates that meet, or that are themselves found in the texts, are drawn again. Few units need that, so
texts carry only these exceptions; all other surrogates are computed in place and no text waits for a join on entities.

A name is found behind a title, a label or a closing of a letter, or by an address of its text that is made of its two
words; its words are then replaced wherever they stand as whole words in that text. A word's stem hangs on the word
alone, its ending on the gender that the text's titles show for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import store

# What counts as an entity, by kind; titles with the gender that they show.
TITLES = {
    "m": r"Mr\.|Herr|Monsieur|Señor|Господин|г-н|Κύριος",
    "f": r"Mrs\.|Ms\.|Frau|Madame|Mme|Señora|Госпожа|г-жа|Κυρία",
    "n": r"Dr\.|Prof\.",
}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_V4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_HEX = "[0-9A-Fa-f]{1,4}"
# Up to six groups before an IPv4 ending, or eight; one run of groups may be left out, but not all of them.
_V6 = "|".join([
    rf"(?:{_HEX}:){{6}}{_V4}", *[rf"(?:{_HEX}:){{{n}}}(?::{_HEX}){{0,{5 - n}}}:{_V4}" for n in range(1, 6)], rf":(?::{_HEX}){{0,5}}:{_V4}",
    rf"(?:{_HEX}:){{7}}{_HEX}", *[rf"(?:{_HEX}:){{{n}}}(?::{_HEX}){{1,{7 - n}}}" for n in range(1, 7)], rf"(?:{_HEX}:){{1,7}}:", rf":(?::{_HEX}){{1,7}}",
])
# Repetitions have bounds and give nothing back: a run of letters of any length costs a bounded number of steps at each of
# them, and no repetition of a group is deep. Longer words are no names (up to eight parts of 64 letters are), and of an
# address with a longer local part, or with more labels, the nearest 64 characters and the first 127 labels are one.
_NAME_WORD = r"\p{Lu}[\p{Ll}'-]{1,63}+(?![\p{Ll}'-])(?:(?<=['-])\p{Lu}[\p{Ll}'-]{0,63}+(?![\p{Ll}'-])){0,7}"
# What stands before the name at the beginning of a line, and on the line before it.
_LABELS = r"(?:Name|Full name|Author|Signed|Signed by|Nom|Nombre|Имя|Όνομα):"
_CLOSINGS = (
    r"(?:Regards|Best regards|Kind regards|Warm regards|Sincerely|Yours sincerely|Yours truly|Yours faithfully|Best wishes"
    r"|Mit freundlichen Grüßen|Viele Grüße|Cordialement|Bien à vous|Saludos|Atentamente|С уважением|Με εκτίμηση)"
)
#: A name of two or three words that ends its line, or goes before an address in angle brackets.
SIGNED = (
    rf"(?m)^[ \t]{{0,8}}+(?:{_LABELS}[ \t]{{1,8}}+|{_CLOSINGS},?+[ \t]{{0,8}}+\r?\n[ \t]{{0,8}}+|From:[ \t]{{1,8}}+(?=[^\n<@]{{1,200}}+<))"
    rf"({_NAME_WORD}(?: {_NAME_WORD}){{1,2}})(?=[ \t]{{0,8}}+(?:\r?$|<))"
)
#: Two capitalised words side by side, and the addresses whose local part is made of two words.
_PAIR = r"(?<![\p{L}'-])(?=(\p{Lu}\p{Ll}{1,63}+ \p{Lu}\p{Ll}{1,63}+)(?![\p{L}'-]))"
_TWO_WORDS = r"^([A-Za-z]{2,32})[._-]([A-Za-z]{2,31})@.*$"
#: What follows the name inside such a word.
_NAME_TAIL = r"(?:'s|['-])*$"
#: Country codes are a prefix code: 1 and 7, these of two digits, all others of three.
_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,63}",
    "secret": r"\b(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}\b|\(\d{3}\) ?\d{3}[ .-]\d{4}\b|\b\d{3}[.-]\d{3}[.-]\d{4}\b",
    "ip": rf"(?<![\d.]){_V4}(?![\d]|\.\d)",
    "ip6": rf"(?<![\p{{L}}\d:.])(?:{_V6})(?![\p{{L}}\d:]|\.\d)",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "card": r"\b\d(?:[ -]?\d){12,18}\b",
    "name": rf"(?<![\p{{L}}])(?:{'|'.join(TITLES.values())}) {_NAME_WORD}(?: {_NAME_WORD}){{0,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Sixteen syllables and endings by script; a hexadecimal digit picks one.
SYLLABLES = {
    "latin": "ba de fi go hu ka le mi no pu ra se ti vo wu za",
    "cyrillic": "ба де фи го ху ка ле ми но пу ра се ти во ву за",
    "greek": "βα δε φι γο χυ κα λε μι νο πυ ρα σε τι βο θυ ζα",
}
ENDINGS = {
    ("latin", "m"): "rn", ("latin", "f"): "lia", ("latin", "n"): "ris", ("latin", "s"): "mer",
    ("cyrillic", "m"): "рин", ("cyrillic", "f"): "лия", ("cyrillic", "n"): "рис", ("cyrillic", "s"): "мер",
    ("greek", "m"): "ρος", ("greek", "f"): "λια", ("greek", "n"): "ρις", ("greek", "s"): "μερ",
}
_ROUNDS = 80
#: Draws after which a kind of its own range gets a wider one: names two more syllables each time, addresses the whole space.
_WIDER = 4


def _kind(match: Column) -> Column:
    """Null for a long number whose last digit checks nothing: that is no card, and stays."""
    number = _luhn(F.regexp_replace(match, r"\D", "")) == 0
    out = F.when(match.rlike(rf"^(?:{PATTERNS['card']})$") & number, "card")
    for kind, pattern in reversed(PATTERNS.items()):
        if kind != "card":
            out = F.when(match.rlike(rf"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _gender(match: Column) -> Column:
    starts = lambda g: match.rlike(rf"^(?:{TITLES[g]}) ")
    return F.when(starts("m"), "m").when(starts("f"), "f").otherwise("n")


def _name_words(match: Column) -> Column:
    return F.slice(F.split(match, " "), 2, 8)


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _bare(word: Column) -> Column:
    """A word of a name without a genitive ending or a loose mark."""
    return F.regexp_replace(word, _NAME_TAIL, "")


def _expanded(match: Column) -> Column:
    """Eight groups of four small hexadecimal digits: all spellings of one IPv6 address are one."""
    v4 = F.split(F.regexp_extract(match, rf"({_V4})$", 1), r"\.")
    pair = lambda i: F.lower(F.hex(F.coalesce(F.get(v4, i).cast("int"), F.lit(0)) * 256 + F.coalesce(F.get(v4, i + 1).cast("int"), F.lit(0))))
    six = F.when(match.contains("."), F.concat(F.regexp_replace(match, rf"{_V4}$", ""), F.concat_ws(":", pair(0), pair(2)))).otherwise(match)
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")

    def filled(x: Column) -> Column:
        head = groups(F.substring_index(x, "::", 1))
        tail = F.when(x.contains("::"), groups(F.substring_index(x, "::", -1))).otherwise(F.array().cast("array<string>"))
        zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(head) - F.size(tail), F.lit(0)))
        return F.array_join(F.transform(F.concat(head, zeros, tail), lambda g: F.lpad(g, 4, "0")), ":")

    return _let(F.lower(six), filled)


def _units(match: Column) -> Column:
    """array<struct<kind, norm>>: what is replaced in a match. Spellings of one number or address have one norm."""
    unit = lambda k, n: F.struct(k.alias("kind"), n.alias("norm"))
    names = F.transform(_name_words(match), lambda w: unit(F.lit("name"), _bare(w)))
    plain = F.regexp_replace(match, r"[^\p{L}\d]", "")
    # Numbers without a country code have the form of those of code 1.
    phone = F.when(match.startswith("+"), plain).otherwise(F.concat(F.lit("1"), plain))

    def found(kind: Column) -> Column:
        norm = F.when(kind == "email", F.lower(match)).when(kind.isin("ip", "secret"), match).when(kind == "ip6", _expanded(match)).when(kind == "phone", phone).otherwise(plain)
        return F.when(kind.isNull(), F.slice(names, 1, 0)).when(kind == "name", names).otherwise(F.array(unit(kind, norm)))

    return _let(_kind(match), found)


def _name_kinds(matches: Column) -> Column:
    """map<word, kind> of the words of a text's names: given names by the gender that all their titles show, the rest surnames."""
    titled = F.filter(matches, lambda m: m.rlike(f"^(?:{PATTERNS['name']})$"))
    role = lambda w, last, g: F.struct(_bare(w).alias("w"), F.when(last, "s").otherwise(g).alias("g"))
    of = lambda m: F.transform(_name_words(m), lambda w, i: role(w, i == F.size(_name_words(m)) - 1, _gender(m)))
    roles = F.array_distinct(F.flatten(F.transform(titled, of)))
    has = lambda w, g: F.exists(roles, lambda r: (r.w == w) & (r.g == g))
    m, f = lambda w: has(w, "m"), lambda w: has(w, "f")
    kind = lambda w: F.when(m(w) & ~f(w), "name_m").when(f(w) & ~m(w), "name_f").when(m(w) | has(w, "n"), "name_n").otherwise("name_s")
    return F.map_from_entries(F.transform(F.array_distinct(F.transform(roles, lambda r: r.w)), lambda w: F.struct(w, kind(w))))


def _name_pattern(words: Column) -> Column:
    """Entities, or else one of the words, longest first."""
    longest = F.array_sort(words, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.concat(F.lit(rf"{ENTITY}|(?<![\p{{L}}\p{{M}}\p{{N}}_])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}_])"))


def _stream(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """128 hexadecimal digits of a nested keyed hash."""
    kind = F.when(kind.startswith("name"), "name").otherwise(kind)
    inner = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm), 256)
    return F.sha2(F.concat(F.lit(key), inner), 512)


def _shaped(norm: Column, stream: Column) -> Column:
    """Digits become digits, letters letters of their case, other characters stay."""
    digits, small = F.translate(stream, "abcdef", "274918"), F.translate(stream, "0123456789abcdef", "bcdfghjkmnprstvw")

    def one(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(128)) + 1
        return (
            F.when(c.rlike(r"^\d$"), digits.substr(at, F.lit(1)))
            .when(c.rlike(r"^\p{Lu}$"), F.upper(small.substr(at, F.lit(1))))
            .when(c.rlike(r"^\p{L}$"), small.substr(at, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(norm, ""), one), "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _mod97(country: Column, check: Column, rest: Column) -> Column:
    """The remainder that is 1 for a valid account number: letters count from 10, country and check digits stand last."""
    value = lambda c: F.when(c.rlike(r"^\d$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.pmod(a * F.when(c.rlike(r"^\d$"), 10).otherwise(100) + F.coalesce(value(c), F.lit(0)), F.lit(97))
    return F.aggregate(F.split(F.concat(rest, country, check), ""), F.lit(0), step)


def _iban(norm: Column, drawn: Column) -> Column:
    country, rest = F.substring(norm, 1, 2), drawn.substr(F.lit(5), F.length(norm))
    held = _mod97(country, F.substring(norm, 3, 2), norm.substr(F.lit(5), F.length(norm))) == 1
    check = F.lpad((98 - _mod97(country, F.lit("00"), rest)).cast("string"), 2, "0")
    return F.concat(country, F.when(held, check).otherwise(F.substring(drawn, 3, 2)), rest)


def _name(kind: Column, norm: Column, stream: Column, attempt: Column) -> Column:
    script = F.when(norm.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(norm.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    gender = F.substring_index(kind, "_", -1)
    nibble = lambda i: F.conv(F.substring(stream, i, 1), 16, 10).cast("int")

    def syllables(known: list[Column]) -> Column:
        more = F.transform(F.sequence(F.lit(5), 4 + 2 * F.floor(attempt / _WIDER).cast("int")), lambda i: F.array(*known)[F.conv(stream.substr(i, F.lit(1)), 16, 10).cast("int")])
        return F.concat(*[F.array(*known)[nibble(i)] for i in (1, 2, 3, 4)], F.when(attempt < _WIDER, "").otherwise(F.array_join(more, "")))

    by_script = [F.when(script == s, syllables(list(map(F.lit, t.split())))) for s, t in SYLLABLES.items()]
    ends = [F.when((script == s) & (gender == g), e) for (s, g), e in ENDINGS.items()]
    return F.initcap(F.concat(F.coalesce(*by_script), F.coalesce(*ends, F.lit(""))))


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The replacement of a unit: same kind, shape, script and gender, and a number's check digit holds where it held.

    Kind name gives a name's stem; name_m, name_f, name_n and name_s the stem and an ending.
    """
    return _let(_stream(key, kind, norm, attempt), lambda s: _drawn(kind, norm, attempt, s))


def _drawn(kind: Column, norm: Column, attempt: Column, s: Column) -> Column:
    octets = [F.conv(F.substring(s, 2 * i + 1, 2), 16, 10) for i in range(4)]
    local, host = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    email = F.concat(_shaped(local, s), F.lit("@"), _shaped(F.substring_index(host, ".", 1), F.reverse(s)), F.lit(".example."), F.substring_index(host, ".", -1))
    drawn = _shaped(norm, s)
    shift = F.pmod(_luhn(norm) - _luhn(drawn) + F.substring(drawn, -1, 1).cast("int"), F.lit(10))
    card = F.concat(drawn.substr(F.lit(1), F.length(norm) - 1), shift.cast("string"))
    code = F.regexp_extract(norm, _CODE, 0)
    quads = [F.substring(s, 4 * i + 1, 4) for i in range(8)]
    wide = lambda known, i: F.when(attempt < _WIDER, known).otherwise(quads[i])
    hexes = F.substring(s, 1, 64).substr(F.lit(1), F.length(norm))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", F.when(attempt < _WIDER, "10").otherwise(octets[3]), *octets[:3]))
        .when(kind == "ip6", F.concat_ws(":", wide("2001", 6), wide("0db8", 7), *quads[:6]))
        .when(kind == "phone", F.concat(code, drawn.substr(F.length(code) + 1, F.length(norm))))
        .when(kind == "secret", F.when(norm == F.upper(norm), F.upper(hexes)).otherwise(hexes))
        .when(kind == "card", card)
        .when(kind == "iban", _iban(norm, drawn))
        .when(kind.startswith("name"), _name(kind, norm, s, attempt))
        .otherwise(drawn)
    )


def _formatted(match: Column, norm_surrogate: Column) -> Column:
    """The surrogate's characters in the places of the match's letters and digits."""
    plain = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}\d]", ""))
    put = lambda c, i: F.when(c.rlike(r"^[\p{L}\d]$"), norm_surrogate.substr(plain(match.substr(F.lit(1), i + 1)), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(match, ""), put), "")


def _rendered(match: Column, kinds: Column, lookup) -> Column:
    """A match with its units replaced; lookup(kind, norm) gives a surrogate, kinds those of the text's name words."""
    bare = F.map_contains_key(kinds, match)
    units = F.when(bare, F.array(F.struct(F.lit("name").alias("kind"), match.alias("norm")))).otherwise(_units(match))
    known = F.transform(units, lambda u: F.struct(F.when(u.kind == "name", F.element_at(kinds, u.norm)).otherwise(u.kind).alias("kind"), u.norm.alias("norm")))
    drawn = F.transform(known, lambda u: F.struct(u.kind.alias("kind"), lookup(u.kind, u.norm).alias("s")))

    def put(d: Column) -> Column:
        kind, first = d[0].kind, d[0].s
        words = F.zip_with(d, _name_words(match), lambda u, w: F.concat(u.s, F.regexp_extract(w, _NAME_TAIL, 0)))
        shouted = (kind == "email") & (match == F.upper(match)) & match.rlike("[A-Z]")
        return (
            F.when(shouted, F.upper(first))
            .when(bare | kind.isin("email", "ip", "ip6", "secret"), first)
            .when(kind.startswith("name"), F.array_join(F.concat(F.slice(F.split(match, " "), 1, 1), words), " "))
            .otherwise(_formatted(match, F.when((kind == "phone") & ~match.startswith("+"), F.substring(first, 2, 64)).otherwise(first)))
        )

    return F.when(F.size(drawn) == 0, match).otherwise(_let(drawn, put))


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def _untitled(text: Column, matches: Column) -> Column:
    """Names that no title shows, behind a title of no gender: signed ones, and pairs of words that an address is made of.

    Pairs and addresses meet by a hash of the pair, so the work is linear in the text.
    """
    signed = F.regexp_extract_all(text, F.lit(SIGNED), F.lit(1))
    addresses = F.filter(matches, lambda m: m.rlike(_TWO_WORDS))
    word = lambda m, k: F.initcap(F.lower(F.regexp_extract(m, _TWO_WORDS, k)))
    either = F.flatten(F.transform(addresses, lambda m: F.array(F.concat_ws(" ", word(m, 1), word(m, 2)), F.concat_ws(" ", word(m, 2), word(m, 1)))))
    met = F.array_intersect(either, F.regexp_extract_all(text, F.lit(_PAIR), F.lit(1)))
    pairs = F.when(F.exists(matches, lambda m: m.rlike(_TWO_WORDS)), met).otherwise(F.array().cast("array<string>"))
    return F.transform(F.concat(signed, pairs), lambda n: F.concat(F.lit("Dr. "), n))


def scan(docs: DataFrame, kept: list[str]) -> DataFrame:
    """row (the kept columns but text), doc_id, text and found, its entities: the one pass that looks for them, written.

    Names without a title come last in found, as if they had one; a text with a name is searched for its words anyway.
    """
    rest = F.struct(*[c for c in kept if c != "text"]).alias("row")
    found = _let(_matches(F.col("text")), lambda ms: F.concat(ms, _untitled(F.col("text"), ms)))
    return store(docs.select(rest, "doc_id", "text", F.coalesce(found, F.array().cast("array<string>")).alias("found")))


def occurrences(scanned: DataFrame) -> DataFrame:
    """(doc_id, kind, norm) of every distinct unit of every document."""
    units = F.array_distinct(F.flatten(F.transform("found", _units)))
    return scanned.where(F.size("found") > 0).select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.kind", "u.norm")


def exceptions(units: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt) of the units whose surrogate was drawn again.

    Each round, of the units with one surrogate that of the fewest draws keeps it (ties: the least), so what is settled
    stays; units whose surrogate is a found unit never keep it.
    """
    at = F.col("attempt")
    now = store(units.withColumn("attempt", F.lit(0)).withColumn("s", surrogate(key, F.col("kind"), F.col("norm"), F.lit(0))))
    for _ in range(_ROUNDS):
        keepers = now.groupBy("kind", "s").agg(F.min(F.struct("attempt", "norm"))["norm"].alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        # A stem is also refused where an ending would make it a found name.
        stems = F.array("norm", F.when(F.col("kind") == "name", F.regexp_replace("norm", rf"(?:{'|'.join(ENDINGS.values())})$", "")).otherwise(F.col("norm")))
        real = now.select("kind", F.explode(F.array_distinct(stems)).alias("s")).distinct().withColumn("real", F.lit(True))
        met = now.join(keepers, ["kind", "s"], "left").join(real, ["kind", "s"], "left")
        again = met.where((F.col("keeper") != F.col("norm")) | F.col("real")).select("kind", "norm")
        again = store(again)
        if again.isEmpty():
            break
        bumped = now.join(again.withColumn("bump", F.lit(1)), ["kind", "norm"], "left").withColumn("attempt", at + F.coalesce("bump", F.lit(0)))
        now = store(bumped.select("kind", "norm", "attempt", surrogate(key, F.col("kind"), F.col("norm"), at).alias("s")))
    else:
        raise RuntimeError("surrogates still collide; a kind has too few values for its units")
    return now.where("attempt > 0").select("kind", "norm", "attempt")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """All columns of docs, text with surrogates, and n_entities (later bare mentions of a name count too).

    Null texts stay null with 0 entities; texts without an entity stay as they are; very long texts are one row like
    others, and so is one without a blank: every pattern is linear in it. Repeated rows are treated alike. An empty table gives no rows. The key is part of the plan: keep event logs as
    private as the key. A column n_entities of docs is replaced; other columns may have any name.
    """
    kept = [c for c in docs.columns if c != "n_entities"]
    scanned = scan(docs, kept)
    found = store(occurrences(scanned))
    drawn_again = store(exceptions(found.select("kind", "norm").distinct(), key))
    text, none = F.col("text"), F.lit(0)
    if drawn_again.isEmpty():
        framed, lookup = scanned, lambda kind, norm: surrogate(key, kind, norm, none)
    else:
        # The few documents with such a unit get their own exceptions; joined on the document, not on the entity. They
        # are written first, so that the planner knows their size and moves no text while that is small. Rows without
        # doc_id get those of all such rows.
        own = found.join(drawn_again, ["kind", "norm"]).select(F.col("doc_id").alias("own"), F.concat_ws(":", "kind", "norm").alias("k"), "attempt")
        maps = store(own.distinct().groupBy("own").agg(F.map_from_entries(F.collect_list(F.struct("k", "attempt"))).alias("attempts")))
        framed = scanned.join(maps, scanned["doc_id"].eqNullSafe(maps["own"]), "left")
        unit = lambda kind, norm: F.concat_ws(":", F.when(kind.startswith("name"), "name").otherwise(kind), norm)
        attempt = lambda kind, norm: F.coalesce(F.element_at(F.col("attempts"), unit(kind, norm)), none)
        lookup = lambda kind, norm: surrogate(key, kind, norm, attempt(kind, norm))
    titled = F.exists("found", lambda m: m.rlike(f"^(?:{PATTERNS['name']})$"))
    named = framed.withColumn("names", F.when((F.size("found") > 0) & titled, _name_kinds(F.col("found"))))
    names = F.col("names")
    pattern = F.when(names.isNull(), ENTITY).otherwise(_name_pattern(F.map_keys(names)))
    kinds = F.coalesce(names, F.create_map().cast("map<string,string>"))

    def put(pattern: Column) -> Column:
        matches = F.when(names.isNull(), F.col("found")).otherwise(F.regexp_extract_all(text, pattern, F.lit(0)))
        return _let(matches, lambda ms: _let(F.transform(ms, lambda m: _rendered(m, kinds, lookup)), lambda rs: joined(pattern, ms, rs)))

    def joined(pattern: Column, matches: Column, rendered: Column) -> Column:
        gaps = F.zip_with(F.split(text, pattern, -1), rendered, lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
        n = F.size(F.filter(F.zip_with(matches, rendered, lambda m, r: m != r), lambda x: x))
        return F.struct(F.array_join(gaps, "").alias("text"), n.cast("bigint").alias("n"))

    whole = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n"))
    done = named.select("row", F.when(F.size("found") > 0, _let(pattern, put)).otherwise(whole).alias("new"))
    return done.select(*[F.col("new.text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in kept], F.col("new.n").alias("n_entities"))
