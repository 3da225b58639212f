"""PII: detected entities get keyed surrogates of the same type, gender, script and format.

The same entity gets the same surrogate everywhere, however it is written, and different entities get different ones:
surrogates of all entities are compared, and those that collide are drawn anew. DataFrame functions only.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let
from .columns import free_prefix, scan, starts_of
from .staging import staged

# Name parts by script: given names of men and of women, and syllables and endings of family names
NAMES = {
    "latin": (
        ["Adam", "Bruno", "Carl", "David", "Edgar", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leon", "Mario", "Noel", "Oscar", "Paul"],
        ["Alice", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula"],
        ["bar", "cor", "dal", "fen", "gar", "hol", "jan", "kel", "lam", "mor", "nor", "par", "ros", "sal", "tor", "wes"],
        ["berg", "den", "ford", "lin", "man", "ner", "son", "ton"],
    ),
    "cyrillic": (
        ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Олег", "Павел", "Роман", "Сергей", "Тимур", "Юрий"],
        ["Алина", "Белла", "Вера", "Галина", "Дарья", "Елена", "Инна", "Ксения", "Лидия", "Мария", "Ольга", "Полина", "Раиса", "София", "Тамара", "Юлия"],
        ["бар", "вол", "гор", "дан", "жар", "зор", "кал", "лам", "мар", "нев", "пол", "рос", "сав", "тар", "фом", "чер"],
        ["ук", "енко", "ых", "як"],
    ),
    "greek": (
        ["Ανδρέας", "Βασίλης", "Γιώργος", "Δημήτρης", "Κώστας", "Λεωνίδας", "Μάριος", "Νίκος", "Πέτρος", "Σπύρος", "Στέφανος", "Φίλιππος"],
        ["Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία", "Χριστίνα"],
        ["βαρ", "γαλ", "δαν", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραλ", "σαμ", "ταρ", "φιλ"],
        ["άκης", "ίδης", "όπουλος", "άτος", "έας", "ούσης"],
    ),
}
#: Family names that say a gender, by their form, and the endings that say the same
GENDERED = {
    "cyrillic": {r"(?:[оеё]в|ин|[сц]кий)\z": ["ин", "ов", "ев", "ский"], r"(?:[оеё]ва|ина|[сц]кая)\z": ["ина", "ова", "ева", "ская"]},
    "greek": {r"[^ς]\z": ["άκη", "ίδου", "οπούλου", "άτου", "έα", "ούση"]},
}
#: Titles and given names that tell a person, by what they say of the gender
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mademoiselle", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "Signora", "Госпожа", "Г-жа", "Κυρία", "السيدة"],
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Г-н", "Κύριος", "السيد"],
    "n": ["Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur", "Rev", "Доктор", "Профессор"],
}
GIVEN = {
    "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Jessica", "Sarah", "Karen", "Lisa", "Nancy", "Anna", "Emma", "Sophie", "Claire", "Carmen", "Lucía", "Ursula", "Sabine", "Jane", "Emily"],
    "m": ["James", "John", "Robert", "Michael", "William", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Steven", "Andrew", "Peter", "Hans", "Jürgen", "Pierre", "Carlos", "José", "Juan", "Luis", "Miguel"],
}
GIVEN = {g: sorted({*GIVEN[g], *(n for parts in NAMES.values() for n in parts[g == "f"])}, key=lambda n: (-len(n), n)) for g in GIVEN}
NEUTRAL = ["Alex", "Robin", "Kim", "Sascha", "Dominique", "Jamie", "Charlie", "Noor"]

#: Words that are names, too: at the start of a sentence, without a name behind them, they are words
COMMON = "Art Baker Banks Bill Black Brown Bush Case Chase Cook Dawn Dean Drew Faith Field Fisher Frank Grace Grant Green Gray Guy Hill Hope Hunter Iris Jack Joy June King Lake Lily Long Mark Mason May Miles Page Park Penny Price Ray Rich Rob Rose Sandy Singer Stone Sue Summer Victor Violet White Will Wood Young Klein Lang Roth Schwarz Braun Weiß Groß Jung Koch Bauer Blanc Petit Grand Roux Rey Rojo Cruz Blanco".split()
#: Common Chinese family names: with one of these a name's beginning shows in running text
HAN_FAMILY = "欧阳 司马 诸葛 上官 王 李 张 刘 陈 杨 黄 赵 吴 周 徐 孙 马 朱 胡 郭 何 高 林 罗 郑 梁 谢 宋 唐 许 韩 冯 邓 曹 彭 曾 肖 田 董 袁 潘 于 蒋 蔡 余 杜 叶 程 苏 魏 吕 丁 任 沈 姚 卢 姜 崔 钟 谭 陆 汪 范 金 石 廖 贾 夏 韦 付 方 白 邹 孟 熊 秦 邱 江 尹 薛 闫 段 雷 侯 龙 史 陶 黎 贺 顾 毛 郝 龚 邵 万 钱 严 覃 武 戴 莫 孔 向 汤".split()

_NAME = r"(?:\p{Lu}\p{L}*(?:['’-]\p{Lu}\p{L}+)*|\p{Lo}\p{L}+)"
_TITLE = "(?:" + "|".join(sorted({w for ts in TITLES.values() for t in ts for w in (t, t.upper())}, key=lambda t: (-len(t), t))) + r")\.?\x20"
_GIVEN = "(?:" + "|".join(n for ns in GIVEN.values() for n in ns) + ")"
_HAN_TITLE = "(?:先生|女士|小姐)"
_HAN_FAMILY = "(?:" + "|".join(HAN_FAMILY) + ")"
_HAN_PERSON = rf"(?:{_HAN_FAMILY}\p{{IsHan}}{{0,2}}|(?<!\p{{L}})(?:(?!{_HAN_FAMILY})\p{{IsHan}}){{1,4}}){_HAN_TITLE}"
_INITIAL = "[" + "".join(sorted({n[0] for group in (TITLES, GIVEN) for ns in group.values() for n in ns})) + "]"

#: Patterns by kind, in order of precedence
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})(?!\.?\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{N}+])(?:\d{13,19}|\d{4}(?:\x20\d{4}){2}\x20\d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4}\x20\d{6}\x20\d{5})(?!\d)",
    "ssn": r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    "phone": r"(?<![\p{N}+])(?<!\p{N}[.-])(?:\+\d{8,15}|(?:\+\d{1,3}[\x20.-]?)?\(\d{3}\)\x20?\d{7}|(?:\+\d{1,3}[\x20.-]\d{2,4}|0\d{2,4})[\x20./-]\d{6,8}|(?:\+\d{1,3}[\x20.-]?\d|0\d)(?:[\x20.-]\d{2}){4}|(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)|\d{2,4})[\x20.-]?\d{3,4}[\x20.-]\d{3,4})(?![.-]?\d)",
    "person": rf"(?:(?={_INITIAL})(?<!\p{{L}})(?:{_TITLE}{_NAME}(?:\x20{_NAME})?|{_GIVEN}\x20{_NAME})|{_HAN_PERSON})",
}
#: Quick tests, each true of every text that holds one of the kinds: most texts need no pattern at all
HINTS = {
    ("email",): lambda text: text.contains("@"),
    ("ip", "iban", "card", "ssn", "phone"): lambda text: text.rlike("[0-9][0-9.)]"),
    ("person",): lambda text: text.rlike(rf"(?={_INITIAL})(?:{_TITLE}|{_GIVEN}\x20)|{_HAN_TITLE}"),
}
#: Further words that are looked up among the names of a text's persons
_HAN_BARE = rf"{_HAN_FAMILY}\p{{IsHan}}{{2}}|(?<!\p{{L}}){_HAN_FAMILY}\p{{IsHan}}(?!\p{{L}})"
_WORD = rf"(?<=\A|[.!?:…]\x20|\n)(?:{'|'.join(COMMON)})(?!\p{{L}}|['’-]\p{{L}}|\x20\p{{Lu}}\p{{Ll}})"
BARE = rf"{_HAN_BARE}|(?<![\p{{L}}\p{{N}}])(?!\p{{IsHan}})(?!{_WORD}){_NAME}"
ENTITIES = "array<struct<kind:string,start:int,end:int,surrogate:string>>"

#: Scripts, by where their letters are; a letter's stand-in is one of its script's
SCRIPTS = {"Cyrillic": (0x430, 0x44F), "Greek": (0x3B1, 0x3C9), "Arabic": (0x627, 0x64A), "Hebrew": (0x5D0, 0x5EA), "Armenian": (0x561, 0x586), "Georgian": (0x10D0, 0x10F0), "Devanagari": (0x905, 0x939), "Bengali": (0x985, 0x9B9), "Tamil": (0xB85, 0xBB9), "Thai": (0xE01, 0xE2E), "Hiragana": (0x3042, 0x3093), "Katakana": (0x30A2, 0x30F3), "Hangul": (0xAC00, 0xAC80), "Han": (0x4E00, 0x4E80)}
ALPHABETS = {k: [c for c in map(chr, range(a, b + 1)) if unicodedata.category(c) in ("Ll", "Lo")] for k, (a, b) in SCRIPTS.items()}
LATIN = list("abcdefghijklmnopqrstuvwxyz")


def _pick(choices: list[str], number: Column) -> Column:
    return F.get(F.split(F.lit(",".join(choices)), ","), F.pmod(number, F.lit(len(choices))).cast("int"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _alike(text: Column, seed: Column) -> Column:
    """Each digit and letter replaced by a keyed one of its kind, script and case; other characters stay."""

    def letter(c: Column, h: Column) -> Column:
        small = F.coalesce(*[F.when(c.rlike(rf"\p{{Is{script}}}"), _pick(letters, h)) for script, letters in ALPHABETS.items()], _pick(LATIN, h))
        return F.when(c.rlike(r"\p{Lu}"), F.upper(small)).otherwise(small)

    def one(c: Column, i: Column) -> Column:
        h = F.xxhash64(seed, i)
        return F.when(c.rlike(r"[a-z]"), _pick(LATIN, h)).when(c.rlike(r"\p{N}"), F.pmod(h, F.lit(10)).cast("string")).when(c.rlike(r"\p{L}"), letter(c, h)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    n = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when((n - i) % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
        return acc + twice

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)


def _surrogate(kind: Column, name: Column, key: str, attempt: int) -> Column:
    """What stands for the entity `name` of `kind`, at the given attempt. From the fourth attempt on names and mails grow,
    from the ninth numbers too, so that there are always enough; an address of four numbers stays one, of which there are 254 ** 4."""

    local, domain = F.regexp_extract(name, r"\A([^@]*)@", 1), F.regexp_extract(name, r"@(.*)\z", 1)
    digits = "0" * max(0, attempt - 7)
    # what is drawn letter by letter, and what of the name stays in front of it
    drawn = F.when(kind == "email", F.concat(local, F.lit("a" * max(0, attempt - 2)))).when(kind.isin("phone", "card"), F.concat(F.lit(digits), F.substring(name, 2, 100)))
    drawn = drawn.when(kind == "iban", F.concat(F.lit(digits), F.substring(name, 3, 100))).when(kind.startswith("given") | (kind == "family"), F.concat(name, F.lit("a" * attempt))).otherwise(F.concat(F.lit(digits), name))
    domain_seed = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 256)
    script = F.coalesce(*[F.when(name.rlike(rf"\p{{Is{x}}}"), x.lower()) for x in ("Cyrillic", "Greek", "Latin")])

    def of(x: Column) -> Column:
        seed, like = x["seed"], x["like"]
        h = [F.xxhash64(seed, F.lit(i)) for i in range(attempt + 3)]
        email = F.concat(like, F.lit("@"), _alike(F.regexp_extract(domain, r"\A(.*)\.[^.]*\z", 1), domain_seed), F.lit("."), F.regexp_extract(domain, r"([^.]*)\z", 1))
        ip = F.concat_ws(".", *[(F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(4)])
        phone = F.concat((F.pmod(F.xxhash64(seed, F.lit("first")), F.lit(8)) + 2).cast("string"), like)
        checked = lambda card: F.concat(card, F.pmod(-_luhn_sum(F.concat(card, F.lit("0"))), F.lit(10)).cast("string"))
        card = let(F.concat(F.substring(name, 1, 1), like), lambda c: F.when(_luhn_sum(name) % 10 == 0, checked(F.substring(c, F.lit(1), F.length(c) - 1))).otherwise(c))

        def named(make) -> Column:
            return F.coalesce(*[F.when(script == s, make(*parts)) for s, parts in NAMES.items()], like)

        ending = lambda end, forms: F.coalesce(*[F.when(name.rlike(form), _pick(ends, h[0])) for form, ends in forms.items()], _pick(end, h[0]))
        family = F.coalesce(*[F.when(script == s, F.initcap(F.concat(*[_pick(begin, x) for x in h[1:]], ending(end, GENDERED.get(s, {}))))) for s, (_, _, begin, end) in NAMES.items()], like)
        # further given names keep apart those that share the first
        given = lambda k: named(lambda *parts: F.array_join(F.array(*[_pick(NEUTRAL if k == 2 else parts[k], x) for x in h[: 1 + max(0, attempt - 1)]]), "-"))
        ways = {"email": email, "ip": ip, "phone": phone, "card": card, "iban": F.concat(F.substring(name, 1, 2), like), "family": family, "given_m": given(0), "given_f": given(1), "given_n": given(2)}
        return F.coalesce(*[F.when(kind == k, v) for k, v in ways.items()], like)

    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, name, F.lit(str(attempt))), 256)
    return let(let(seed, lambda s: F.struct(s.alias("seed"), _alike(drawn, s).alias("like"))), of)


def _kind(mention: Column) -> Column:
    return F.coalesce(*[F.when(mention.rlike(rf"\A(?:{p})\z"), F.lit(k)) for k, p in PATTERNS.items()], F.lit("bare"))


def _gender(title: Column, given: Column) -> Column:
    """By the title, else by the given name, else n."""
    bare = F.lower(F.rtrim(F.replace(title, F.lit("."))))
    told = {g: [t.lower() for t in ts] for g, ts in TITLES.items()}
    return F.when(bare.isin(told["f"]), "f").when(bare.isin(told["m"]), "m").when(given.isin(GIVEN["f"]), "f").when(given.isin(GIVEN["m"]), "m").otherwise("n")


def _parts(kind: Column, mention: Column) -> Column:
    """The entities of a mention, by kind and normal name: one, or the given and the family name of a person."""
    title = F.regexp_extract(mention, rf"\A({_TITLE})", 1)
    names = F.split(F.regexp_replace(mention, rf"\A{_TITLE}|{_HAN_TITLE}\z", ""), " ")

    def part(w: Column, i: Column) -> Column:
        given = ((F.size(names) == 2) & (i == 0)) | ((F.size(names) == 1) & w.isin(GIVEN["f"] + GIVEN["m"]))
        return F.struct(F.when(given, F.concat(F.lit("given_"), _gender(title, w))).otherwise("family").alias("kind"), F.lower(w).alias("name"))

    digits = F.when(kind == "phone", F.regexp_extract(_digits(mention), r"(\d{1,10})\z", 1)).otherwise(_digits(mention))
    name = F.when(kind.isin("email", "bare"), F.lower(mention)).when(kind.isin("phone", "card", "ssn"), digits).when(kind == "iban", F.replace(mention, F.lit(" "))).otherwise(mention)
    return F.when(kind == "person", F.transform(names, part)).otherwise(F.array(F.struct(kind.alias("kind"), name.alias("name"))))


def _in_format(mention: Column, value: Column) -> Column:
    """The characters of `value` in the places of the mention's letters and digits, counted from the right, so that a
    country code in front stays; what is longer stands in front."""
    alnum = r"[\p{L}\p{N}]"
    ahead = F.length(value) - F.length(F.regexp_replace(mention, r"[^\p{L}\p{N}]", ""))

    def put(before: Column) -> Column:
        def step(n: Column, c: Column) -> tuple[Column, Column]:
            place = n + before
            return F.when(c.rlike(alnum), n + 1).otherwise(n), F.when(c.rlike(alnum) & (place >= 0), F.substring(value, place + 1, F.lit(1))).otherwise(c)

        return F.concat(F.substring(value, F.lit(1), F.greatest(before, F.lit(0))), F.array_join(scan(F.split(mention, ""), F.lit(0), step, "string"), ""))

    return let(ahead, put)


def _written(kind: Column, mention: Column, surrogates: Column) -> Column:
    """The surrogates in the mention's format."""
    first = F.get(surrogates, 0)
    as_cased = lambda m: F.when(m == F.lower(m), first).when((m == F.upper(m)) & (F.length(m) > 1), F.upper(first)).otherwise(F.concat(F.upper(F.substring(first, 1, 1)), F.substring(first, F.lit(2), F.length(first))))
    names = F.array_join(surrogates, " ")
    names = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(names)).otherwise(names)
    person = F.concat(F.regexp_extract(mention, rf"\A({_TITLE})", 1), names, F.regexp_extract(mention, rf"({_HAN_TITLE})\z", 1))
    bare = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)) & (F.length(mention) > 1), F.upper(first)).otherwise(first)
    return F.when(kind == "email", as_cased(mention)).when(kind == "ip", first).when(kind == "person", person).when(kind == "bare", bare).otherwise(_in_format(mention, first))


def name_entities(entities: DataFrame, key: str) -> DataFrame:
    """(kind, name, surrogate) of distinct (kind, name): no two share a surrogate in what is compared, kinds or all given
    names, and none is an entity's own name there.

    Each round draws for those that have none yet, until all have one; draws get longer, so this ends.
    """
    spark = entities.sparkSession
    space = F.split("kind", "_")[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = entities.select(space.alias("space"), F.col("name").alias("low"))
    waiting, done, attempt = entities, None, 0
    while True:
        drawn = waiting.repartition(parts, "kind", "name").select("kind", "name", _surrogate(F.col("kind"), F.col("name"), key, attempt).alias("surrogate"))
        # one of those that drew the same keeps it: the least name
        first = drawn.groupBy(space.alias("space"), F.lower("surrogate").alias("low")).agg(F.min(F.struct("name", "kind", "surrogate")).alias("m"))
        first = first.join(taken, ["space", "low"], "left_anti")
        kept = staged(first.select("m.kind", "m.name", "m.surrogate"), "pii_names")
        done = kept if done is None else done.unionByName(kept)
        taken = taken.unionByName(kept.select(space.alias("space"), F.lower("surrogate").alias("low")))
        waiting = staged(waiting.join(kept.select("kind", "name"), ["kind", "name"], "left_anti"), "pii_waiting")
        if waiting.isEmpty():
            return done
        attempt += 1


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with the entities in `text` replaced, and `entities` added: (kind, start, end, surrogate) in code points of
    the original text, in order.

    Kinds: email, ip, iban, card, ssn, phone, and person: a title and one or two names, or a common given name and
    another, and in the same text each bare word that is one of these names. Entities are known by their normal form: case
    of emails and names, spaces and separators of numbers, and country codes of phones don't matter, and a person's given
    and family names are entities of their own. A word behind a person's bare given name is a family name. A bare name that is
    a common word (COMMON) stays where it begins a sentence and no capitalised word follows. Chinese names are found by their
    titles; those that begin with a common family name also in running text, and there bare ones of three characters or more.
    Parts of longer numbers with separators, and dates, are no phones. Names that neither a title nor a common given name introduces anywhere in
    the text aren't found. A given name whose mention tells no gender takes that of its other mentions in the text.

    Null texts stay null, empty ones empty. Repeated rows come back as often; no rows give none. A column `entities` of the
    input is replaced; others pass through, whatever their names.
    """
    docs = docs.drop("entities")
    p, text = free_prefix(docs), F.col("text")
    row, found, again = p + "row", p + "found", p + "again"
    hinted = F.concat_ws("|", *[F.when(hint(text), "|".join(f"(?:{PATTERNS[k]})" for k in kinds)) for kinds, hint in HINTS.items()])
    rows = docs.select("*", F.monotonically_increasing_id().alias(row), hinted.alias(p + "pattern"))
    matches = F.when(F.col(p + "pattern") != "", F.regexp_extract_all(text, F.col(p + "pattern"), F.lit(0)))
    rows = staged(rows.select("*", F.coalesce(matches, F.expr("cast(array() as array<string>)")).alias(found)), "pii_found")
    without = rows.where(F.size(found) == 0).select(*docs.columns, F.expr(f"cast(array() as {ENTITIES})").alias("entities"))
    persons = F.exists(found, lambda m: _kind(m) == "person")
    rows = rows.where(F.size(found) > 0).withColumn(p + "pattern", F.concat_ws("|", p + "pattern", F.when(persons, F.lit(BARE))))
    rows = rows.withColumn(again, F.regexp_extract_all(text, F.col(p + "pattern"), F.lit(0)))
    gaps = F.split("text", F.col(p + "pattern"), -1)
    mentions = F.arrays_zip(F.col(again).alias("mention"), F.transform(gaps, lambda g: g == " ").alias("behind_one"))
    mentions = rows.select(F.col(row).alias("row"), F.posexplode(mentions).alias("pos", "m")).where("m.mention IS NOT NULL")
    named = _named(mentions.select("row", "pos", "m.mention", "m.behind_one"), key)
    of_row = named.select(F.col("row").alias(p + "of"), F.col("s").alias(p + "s"))
    joined = rows.join(of_row, F.col(row) == F.col(p + "of"), "left")
    return without.unionByName(joined.select(*docs.columns, again, p + "s", p + "pattern").select(*_rebuilt(docs.columns, p, again)))


def _named(mentions: DataFrame, key: str) -> DataFrame:
    """(row, s): of mentions (row, pos, mention, behind_one), the (pos, kind, surrogate) of those that are entities, by pos.
    A mention is `behind_one` if nothing but a blank is between it and the one before."""
    kinds = mentions.select("row", "pos", "mention", "behind_one", _kind(F.col("mention")).alias("m_kind"))
    parts = kinds.select("*", F.posexplode(_parts(F.col("m_kind"), F.col("mention"))).alias("part", "entity")).select("row", "pos", "mention", "behind_one", "m_kind", "part", "entity.kind", "entity.name")
    parts = staged(parts, "pii_parts")
    known = F.min(F.when(F.col("kind").startswith("given_"), F.col("kind"))).over(Window.partitionBy("row", "name"))
    persons = parts.where("m_kind = 'person'").withColumn("kind", F.when(F.col("kind") == "given_n", known).otherwise(F.col("kind")))
    names = persons.groupBy("row", "name").agg(F.min("kind").alias("kind")).where(F.length("name") > 1)
    words = parts.where("m_kind = 'bare'").drop("kind")
    bare = words.join(names, ["row", "name"])
    # a word right behind a person's bare given name is a family name, here and wherever it stands in the text
    given = bare.where("kind LIKE 'given%'").select("row", (F.col("pos") + 1).alias("pos")).distinct()
    further = words.where("behind_one").join(given, ["row", "pos"]).select("row", "name").distinct()
    further = further.join(names, ["row", "name"], "left_anti").where(F.length("name") > 1).withColumn("kind", F.lit("family"))
    bare = words.join(names.unionByName(further), ["row", "name"])
    parts = staged(parts.where("m_kind NOT IN ('person', 'bare')").unionByName(persons).unionByName(bare), "pii_mentions")
    surrogates = name_entities(staged(parts.select("kind", "name").distinct(), "pii_entities"), key)
    one = parts.join(surrogates, ["kind", "name"]).groupBy("row", "pos", "mention", "m_kind").agg(F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("s"))
    written = _written(F.col("m_kind"), F.col("mention"), F.col("s.surrogate"))
    kind = F.when(F.col("m_kind") == "bare", "person").otherwise(F.col("m_kind"))
    return one.select("row", F.struct("pos", kind.alias("kind"), written.alias("surrogate")).alias("s")).groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s"))


def _rebuilt(columns: list[str], p: str, again: str) -> list[Column]:
    """The columns, with the text put together anew, and `entities`."""
    named, words = F.coalesce(p + "s", F.expr("cast(array() as array<struct<pos:int,kind:string,surrogate:string>>)")), F.col(again)
    gaps = F.split("text", F.col(p + "pattern"), -1)

    def aligned(found: Column, size: Column) -> Column:
        """For each match its entity, or null: both go by place."""

        def step(at: Column, i: Column) -> tuple[Column, Column]:
            here = F.get(found, at)["pos"] == i
            return F.when(here, at + 1).otherwise(at), F.when(here, F.get(found, at))

        return scan(F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.expr("cast(array() as array<int>)")), F.lit(0), step, "struct<pos:int,kind:string,surrogate:string>")

    def put(gaps: Column, own: Column) -> Column:
        before = F.slice(gaps, F.lit(1), F.size(words))
        pieces = F.zip_with(before, F.zip_with(words, own, lambda w, x: F.coalesce(x["surrogate"], w)), lambda g, w: F.concat(g, w))
        starts = F.zip_with(starts_of(F.zip_with(before, words, lambda g, w: F.length(g) + F.length(w))), before, lambda s, g: s + F.length(g))
        spans = F.zip_with(F.zip_with(starts, words, lambda s, w: F.struct(s.alias("start"), (s + F.length(w)).alias("end"))), own, lambda s, x: F.when(x.isNotNull(), F.struct(x["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), x["surrogate"].alias("surrogate"))))
        return F.struct(F.concat(F.array_join(pieces, ""), F.element_at(gaps, -1)).alias("text"), F.filter(spans, lambda x: x.isNotNull()).cast(ENTITIES).alias("entities"))

    whole = let(gaps, lambda g: let(let(named, lambda n: aligned(n, F.size(words))), lambda own: put(g, own)))
    return [whole["text"].alias(c) if c == "text" else F.col(c) for c in columns] + [whole["entities"].alias("entities")]


def pii_digest(docs: DataFrame, key: str) -> DataFrame:
    """The new texts and counts of replace_pii(), which says how odd rows are taken; one row for each row of `docs`."""
    out = replace_pii(docs.select("doc_id", "text"), key)
    count = lambda kind: F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), *[count(k) for k in PATTERNS])
