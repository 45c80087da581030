"""Surrogates for personal data and secrets, in DataFrame expressions only.

Entities are found by one pattern. Each gets a surrogate from a keyed digest of
its kind and canonical form, so all spellings of one entity, in all documents,
lead to the same surrogate: emails get a reserved domain, phone and social
security numbers keep their layout, cards their issuer digit and a right check
digit, IBANs their country and right check digits, names their script and gender,
secrets their character classes. Letters of other scripts in mail addresses become
letters of the same script where ``LETTERS`` has it and Latin ones otherwise; digits of
all scripts become 0 to 9 and combining marks are left out.

Collision check: over the distinct entities of all documents no two may share a
surrogate and none may equal a real entity. Those that do are drawn again until no
clash is left. After ``SAME_LENGTH`` draws mail names, person names and secrets grow by
a few characters, so small spaces of surrogates do not run out. That table holds each entity once. Texts need no join unless there
are entities that were drawn again.

Without the key surrogates can neither be predicted nor undone.

Defined results: a null text stays null; texts without entities are unchanged;
rows repeat as often as in the input; card-like numbers with a wrong check digit
and dotted numbers beyond 255 are no entities, nor are secrets without a letter or
digit (blank form fields); an entity is at most 128 characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir

# Given names by script and gender, syllables for surnames, words before secrets.
GIVEN = {
    "latin_f": ["Anna", "Maria", "Julia", "Sophie", "Laura", "Claire", "Emma", "Elena", "Carmen", "Ingrid", "Alice", "Louise"],
    "latin_m": ["Thomas", "Peter", "Martin", "Pierre", "Carlos", "Michael", "David", "Stefan", "Jacques", "Miguel", "Robert", "James"],
    "cyrillic_f": ["Анна", "Мария", "Ольга", "Елена", "Наталья", "Ирина", "Татьяна", "Светлана"],
    "cyrillic_m": ["Иван", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил", "Павел"],
    "greek_f": ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Δήμητρα"],
    "greek_m": ["Γιώργος", "Νίκος", "Κώστας", "Δημήτρης", "Γιάννης", "Πέτρος"],
}
SYLLABLES = {
    "latin": ["bar", "den", "fol", "gar", "hem", "jor", "kel", "lan", "mor", "nes", "pal", "rin", "sal", "tor", "vel", "win"],
    "cyrillic": ["бар", "вел", "гор", "дор", "жел", "зар", "кор", "лан", "мар", "нов", "пет", "рад", "сол", "тар", "чер", "шар"],
    "greek": ["βαλ", "γερ", "δαν", "ζαρ", "καλ", "λαμ", "μαν", "νικ", "παν", "ραφ", "σαν", "ταρ", "φιλ", "χαρ", "θεο", "κων"],
}
#: Letters that replace those of each script, by its name in patterns.
LETTERS = {
    "Han": "山川水火木林石田土日月星花草鳥魚馬牛羊米竹雨雪雲風天海江河湖金玉",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミム",
    "Hangul": "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허고노도로",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    "Bengali": "কখগঘচছজঝটঠডঢতথদধনপফবভমযরলশষসহ",
    "Tamil": "கஙசஞடணதநபமயரலவழளறன",
    "Thai": "กขคงจฉชซญดตถทนบปผพฟมยรลวสหอ",
}
#: Draws before surrogates grow; each as many more add another two characters.
SAME_LENGTH = 4
#: For each of 16 values the character that names of a script grow by.
GROWTH = {"latin": "aeioubdfgklmnrst", "cyrillic": "аеиоубдфгклмнрст", "greek": "αειουβδφγκλμνρστ"}
SECRET_WORDS = ["token", "password", "passwd", "secret", "api_key", "apikey", "access_key"]

_SECRET_HEAD = rf"(?i:(?:{'|'.join(SECRET_WORDS)})\s{{0,3}}[=:]\s{{0,3}}[\"']?)"
_NAMES = "|".join(n for names in GIVEN.values() for n in names)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Every entity begins where no letter, digit or underscore precedes. Each group of
#: alternatives looks at one character first, so most places of a text fail at once.
_NUMERIC = "|".join(
    [
        r"\+\d{1,3}[ .\-]?\(?\d{2,4}\)?[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\w)",
        r"\(\d{3}\) ?\d{3}[\-.]\d{4}(?!\w)",
        r"(?<![.\-])\d{3}[\-.]\d{3}[\-.]\d{4}(?![\w\-])",
        r"(?<!-)\d{3}-\d{2}-\d{4}(?![\w\-])",
        r"(?<!\.)(?:%s\.){3}%s(?!\w|\.\d)" % (_OCTET, _OCTET),
        r"(?<!-)\d{4}([ \-])\d{4}\1\d{4}\1\d{4}(?![\w\-])",
        r"(?<!-)3\d{3}([ \-])\d{6}\2\d{5}(?![\w\-])",
        r"\d{13,19}(?!\w)",
    ]
)
PATTERN = (
    r"(?<![\p{L}\d_])(?:"
    rf"(?=[0-9+(])(?:{_NUMERIC})"
    rf"|(?=[{''.join(sorted({c for w in SECRET_WORDS for c in (w[0], w[0].upper())}))}])"
    rf"(?:{_SECRET_HEAD}[A-Za-z0-9_+/\-]{{8,96}}={{0,2}}|AKIA[0-9A-Z]{{16}}(?!\w))"
    r"|(?=[\p{L}\p{Nd}])(?<![\p{M}\p{Nd}._%+\-])[\p{L}\p{M}\p{Nd}._%+\-]{1,63}+@[A-Za-z0-9][A-Za-z0-9\-]{0,30}(?:\.[A-Za-z0-9\-]{2,24}){1,3}"
    r"|(?=[A-Z]{2}\d)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
    rf"|(?=\p{{Lu}}\p{{Ll}})(?:{_NAMES})\s{{1,2}}\p{{Lu}}\p{{L}}{{1,30}}(?!\p{{L}}))"
)


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, "[^0-9]", "")


def _at(text: Column, i: Column) -> Column:
    return F.substr(text, i, F.lit(1))


def _chars(text: Column, fn) -> Column:
    """The text with each character replaced by ``fn(character, place from 1)``."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: fn(_at(text, i), i)), "")


def luhn_rest(digits: Column) -> Column:
    """Luhn sum modulo 10 of a digit string; 0 for a valid card number."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(_at(digits, n - i)) - 48  # total, as shared expressions may run for other kinds too
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0), add) % 10


def iban_rest(account: Column) -> Column:
    """An IBAN modulo 97, its first four characters moved to the end; 1 for a valid one."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(_at(moved, i))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _gender(given: Column) -> Column:
    out = F.lit(None).cast("string")
    for group, names in GIVEN.items():
        out = F.when(given.isin(names), F.lit(group)).otherwise(out)
    return out


def kind_of(e: Column) -> Column:
    """Kind of a found entity; null for one that is no entity after all."""
    digits = _digits(e)
    account = F.replace(e, F.lit(" "))
    return (
        F.when(e.rlike("^" + _SECRET_HEAD + "[^@]*$"), F.when(e.rlike("^" + _SECRET_HEAD + "[^A-Za-z0-9]*[A-Za-z0-9]"), "secret"))
        .when(e.rlike("^AKIA[0-9A-Z]{16}$"), "secret")
        .when(e.contains("@"), "email")
        .when(e.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(e.rlike(r"^[+(]") | e.rlike(r"^\d{3}[\-.]\d{3}[\-.]\d{4}$"), "phone")
        .when(e.rlike(r"^[0-9 \-]+$"), F.when(luhn_rest(digits) == 0, "card"))
        .when(e.rlike(r"^[A-Z]{2}\d{2}"), F.when((F.length(account) >= 15) & (iban_rest(account) == 1), "iban"))
        .when(e.rlike(r"^\p{L}+\s+\p{L}+$"), "name")
    )


def _secret_head(e: Column) -> Column:
    return F.regexp_extract(e, "^(" + _SECRET_HEAD + ")", 1)


def canonical(e: Column, kind: Column) -> Column:
    """One form for all spellings of an entity."""
    return (
        F.when(kind == "email", F.lower(e))
        .when(kind == "phone", F.concat(F.when(e.startswith("+"), "+").otherwise(""), _digits(e)))
        .when(kind.isin("card", "ssn"), _digits(e))
        .when(kind == "iban", F.replace(e, F.lit(" ")))
        .when(kind == "name", F.regexp_replace(e, r"\s+", " "))
        .when(kind == "secret", F.substr(e, F.length(_secret_head(e)) + 1))
        .otherwise(e)
    )


def surrogate(form: Column, kind: Column, key: str, attempt: Column) -> Column:
    """The replacement of a canonical form; ``attempt`` counts the draws."""
    seed = F.concat_ws("\u0000", F.lit(key), kind, form, attempt.cast("string"), F.lit(key))
    stream = F.concat(F.sha2(F.concat(seed, F.lit("a")), 512), F.sha2(F.concat(seed, F.lit("b")), 512))
    number = lambda i: F.conv(F.substr(stream, (i - 1) % 64 * 4 + 1, F.lit(4)), 16, 10).cast("int")

    def pick(items: str, i: Column) -> Column:
        return F.substr(F.lit(items), number(i) % len(items) + 1, F.lit(1))

    def foreign(c: Column, i: Column) -> Column:
        kinds = {"Nd": "0123456789", "Ll": "abcdefghijklmnopqrstuvwxyz", "Lu": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "M": ""}
        kinds |= {f"Is{script}": letters for script, letters in LETTERS.items()} | {"L": kinds["Ll"]}
        found = F.lit(None).cast("string")
        for name, letters in reversed(kinds.items()):
            found = F.when(c.rlike(rf"\p{{{name}}}"), letters).otherwise(found)
        letters = F.coalesce(found, c)
        return F.substr(letters, number(i) % F.greatest(F.length(letters), F.lit(1)) + 1, F.lit(1))

    def shaped(text: Column) -> Column:
        hexadecimal = text.rlike("^[0-9a-f]*[a-f][0-9a-f]*$")
        return _chars(
            text,
            lambda c, i: F.when(hexadecimal, pick("0123456789abcdef", i))
            .when(c.rlike("[0-9]"), pick("0123456789", i))
            .when(c.rlike(r"\p{Ll}"), pick("abcdefghijklmnopqrstuvwxyz", i))
            .when(c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
            .otherwise(c),
        )

    mapped = shaped(form)
    longer = F.least(F.lit(60), F.floor(attempt / SAME_LENGTH).cast("int") * 2)
    more = F.substr(F.sha2(F.concat(seed, F.lit("c")), 256), F.lit(1), longer)
    user = F.when(form.rlike(r"[^\x00-\x7F]"), _chars(F.substring_index(form, "@", 1), foreign)).otherwise(F.substring_index(mapped, "@", 1))
    domain = F.substring_index(form, "@", -1)
    place = F.substr(F.sha2(F.concat_ws("\u0000", F.lit(key), F.lit("domain"), domain), 256), F.lit(1), F.lit(8))
    body = F.concat(F.substr(form, F.lit(1), F.lit(1)), F.substr(mapped, F.lit(2), F.length(form) - 2))
    check = (10 - luhn_rest(F.concat(body, F.lit("0")))) % 10
    country, tail = F.substr(form, F.lit(1), F.lit(2)), F.substr(mapped, F.lit(5))
    iban_check = F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), tail))).cast("string"), 2, "0")
    octets = [number(F.lit(1)) % 223 + 1, *[number(F.lit(k)) % 256 for k in (2, 3, 4)]]
    group = F.coalesce(_gender(F.substring_index(form, " ", 1)), F.lit("latin_f"))
    person = F.lit(None).cast("string")
    for name, given in GIVEN.items():
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[name.split("_")[0]]])
        parts = [F.get(syllables, number(F.lit(k)) % 16) for k in (2, 3, 4, 5)]
        first = F.get(F.array(*[F.lit(g) for g in given]), number(F.lit(1)) % len(given))
        added = F.translate(more, "0123456789abcdef", GROWTH[name.split("_")[0]])
        person = F.when(group == name, F.concat(first, F.lit(" "), F.initcap(F.concat(*parts)), added)).otherwise(person)
    return (
        F.when(kind == "email", F.concat(user, more, F.lit("@m"), place, F.lit(".example")))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "iban", F.concat(country, iban_check, tail))
        .when((kind == "phone") & form.startswith("+"), F.concat(F.substr(form, F.lit(1), F.lit(2)), F.substr(mapped, F.lit(3))))
        .when((kind == "secret") & form.startswith("AKIA"), F.concat(F.lit("AKIA"), F.substr(mapped, F.lit(5))))
        .when(kind == "name", person)
        .when(kind == "secret", F.concat(mapped, more))
        .otherwise(mapped)
    )


def render(e: Column, kind: Column, new: Column) -> Column:
    """The surrogate in the spelling of the occurrence: digit layout, blanks, case."""
    digits = _digits(new)
    laid_out = _chars(
        e, lambda c, i: F.when(c.rlike("[0-9]"), _at(digits, F.length(_digits(F.substr(e, F.lit(1), i))))).otherwise(c)
    )
    spaced = F.trim(F.regexp_replace(new, "(.{4})", "$1 "))
    return (
        F.when(kind.isin("phone", "card", "ssn"), laid_out)
        .when((kind == "iban") & e.contains(" "), spaced)
        .when((kind == "email") & e.rlike("^[^a-z]*$"), F.upper(new))
        .when(kind == "secret", F.concat(_secret_head(e), new))
        .otherwise(new)
    )


def _found(text: Column) -> Column:
    """Entities of a text as array<struct<e, kind, form>>, in order; kind is null for no entity."""
    typed = F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda e: F.struct(e.alias("e"), kind_of(e).alias("kind")))
    return F.transform(typed, lambda x: F.struct(x["e"].alias("e"), x["kind"].alias("kind"), canonical(x["e"], x["kind"]).alias("form")))


def redrawn(entities: DataFrame, key: str) -> DataFrame | None:
    """(kind, form, new) of entities whose first surrogate clashes, after drawing again; None if there are none.

    ``entities`` has kind and form. The first holder of a surrogate, in order of
    form, keeps it.
    """
    ensure_checkpoint_dir(entities.sparkSession)
    # a row takes a while, so rows are spread by number and not by bytes, which are few
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = entities.distinct().repartition(parts, "kind", "form")
    open_ = distinct.withColumn("new", surrogate(F.col("form"), F.col("kind"), key, F.lit(0))).checkpoint()
    taken = open_.select(F.col("kind").alias("k"), F.col("form").alias("taken"))
    settled, attempt = None, 0
    while True:
        first = open_.groupBy("kind", "new").agg(F.min("form").alias("holder"))
        holders = first.join(taken, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("taken")), "left_anti")
        good = open_.join(holders.withColumnRenamed("holder", "form"), ["kind", "new", "form"], "left_semi").checkpoint()
        bad = open_.join(good, ["kind", "form"], "left_anti").select("kind", "form").checkpoint()
        if attempt:
            settled = good if settled is None else settled.unionByName(good)
        if bad.isEmpty():
            return settled
        taken = taken.unionByName(good.select(F.col("kind").alias("k"), F.col("new").alias("taken")))
        attempt += 1
        open_ = bad.withColumn("new", surrogate(F.col("form"), F.col("kind"), key, F.lit(attempt))).checkpoint()


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows of ``docs`` as (row, text_clean, kinds): the replaced text and the kind of each entity in order.

    ``row`` is a struct of the input columns, so their names cannot clash.
    """
    if not key:
        raise ValueError("surrogates need a key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("body"))
    entities = rows.select(F.explode(_found(F.col("body"))).alias("x")).filter("x.kind is not null").select("x.kind", "x.form")
    again = redrawn(entities, key)
    marked = rows.withColumn("found", _found(F.col("body")))
    if again is None:
        known = marked.withColumn("other", F.create_map().cast("map<string,string>"))
    else:
        asked = marked.select(F.xxhash64("body").alias("h"), F.explode("found").alias("x")).select("h", "x.kind", "x.form")
        maps = (
            asked.distinct().join(again, ["kind", "form"]).groupBy("h")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\u0000", "kind", "form"), "new"))).alias("other"))
        )
        known = marked.withColumn("h", F.xxhash64("body")).join(maps, "h", "left")

    def replaced(x: Column) -> Column:
        special = F.try_element_at(F.col("other"), F.concat_ws("\u0000", x["kind"], x["form"]))
        new = F.coalesce(special, surrogate(x["form"], x["kind"], key, F.lit(0)))
        return F.when(x["kind"].isNull(), x["e"]).otherwise(render(x["e"], x["kind"], new))

    between = F.split("body", PATTERN, -1)
    ends = F.concat(F.transform("found", replaced), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(between, ends, lambda a, b: F.concat(a, b)), "")
    return known.select(
        "row",
        F.when(F.size("found") > 0, whole).otherwise(F.col("body")).alias("text_clean"),
        F.transform(F.filter("found", lambda x: x["kind"].isNotNull()), lambda x: x["kind"]).alias("kinds"),
    )
