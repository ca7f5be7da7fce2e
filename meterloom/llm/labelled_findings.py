"""Labelled findings for the secret scan: texts with one value each, of many shapes.

The values are drawn by hashes of the row number, so a table of any size is the same in every run, and
Spark makes it where it is read. Secrets and harmless values share their alphabets and lengths on
purpose (a token and a commit are 40 hex digits, a password and a session name are short mixes), so
that no feature of the value alone tells them apart; the words around and before them do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words around findings.
FILLER = "the and then with some more of this that here see also was for when made open read next line".split()
NAMES = "user report main index data image north river paper window garden summer detail sample letter".split()
SECRET_KEYS = "token secret api_key apikey password passwd pwd auth credential access_key private_key".split()
HARMLESS_KEYS = "commit sha checksum md5 etag uuid build version session_name digest revision trace".split()


def _digest(salt: str) -> Column:
    return F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(f" {salt}")), 512)


def _hex(salt: str, n: int) -> Column:
    return F.substring(_digest(salt), 1, n)


def _digits(salt: str, n: int) -> Column:
    return F.substring(F.translate(_digest(salt), "abcdef", "730528"), 1, n)


def _mixed(salt: str, n: int) -> Column:
    """Letters of both cases and digits."""
    return F.substring(F.regexp_replace(F.base64(F.unhex(_digest(salt))), "[^A-Za-z0-9]", ""), 1, n)


def _one(salt: str, words: list[str]) -> Column:
    place = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(len(words))).cast("int")
    return F.get(F.array(*map(F.lit, words)), place)


def _assigned(keys: list[str], value: Column) -> Column:
    """key, a sign between, and the value, quoted or not."""
    sign = _one("sign", ["=", " = ", ": ", '="', ' = "', ": '"])
    close = F.when(sign.endswith('"'), '"').when(sign.endswith("'"), "'").otherwise("")
    return F.concat(_one("key", keys), sign, value, close)


def shapes() -> dict[str, tuple[int, Column]]:
    """Name, label (1 for a secret) and text of every shape."""
    uuid = F.concat_ws("-", _hex("a", 8), _hex("b", 4), _hex("c", 4), _hex("d", 4), _hex("e", 12))
    jwt = F.concat(F.lit("eyJ"), _mixed("a", 17), F.lit(".eyJ"), _mixed("b", 30), F.lit("."), _mixed("c", 40))
    login = F.concat(F.lit("postgres://admin:"), _mixed("a", 14), F.lit("@db"), _digits("b", 1), F.lit(".local/main"))
    page = F.concat(F.lit("https://example.org/"), _one("n", NAMES), F.lit("/"), _digits("a", 8), F.lit(".html"))
    file = F.concat(F.lit("/usr/lib/"), _one("n", NAMES), F.lit("/"), _hex("a", 8), F.lit(".so.1"))
    mail = F.concat(_one("n", NAMES), F.lit("."), _digits("a", 3), F.lit("@mail.example.com"))
    release = F.concat(_one("n", NAMES), F.lit("-"), _digits("a", 1), F.lit("."), _digits("b", 2), F.lit("-release"))
    loud = F.concat(F.upper(_one("n", NAMES)), F.upper(_one("m", NAMES)), _digits("a", 1))
    name = F.concat(F.lit("get"), F.initcap(_one("n", NAMES)), F.initcap(_one("m", NAMES)), _digits("a", 1))
    stand_in = F.concat(_one("n", NAMES), F.lit("_example_"), _digits("a", 2))
    moment = F.concat(
        F.lit("20"), _digits("a", 2), F.lit("-0"), _digits("b", 1), F.lit("-1"), _digits("c", 1), F.lit("T10:00:00Z")
    )
    phone = F.concat(F.lit("+49-"), _digits("a", 3), F.lit("-"), _digits("b", 8))
    return {
        "hex_40_secret": (1, _assigned(SECRET_KEYS, _hex("v", 40))),
        "hex_32_secret": (1, _assigned(SECRET_KEYS, _hex("v", 32))),
        "hex_18_secret": (1, _assigned(SECRET_KEYS, _hex("v", 18))),
        "mixed_40_secret": (1, _assigned(SECRET_KEYS, _mixed("v", 40))),
        "mixed_14_secret": (1, _assigned(SECRET_KEYS, _mixed("v", 14))),
        "access_id": (1, F.concat(F.lit("AKIA"), F.upper(_mixed("v", 16)))),
        "live_key": (1, F.concat(F.lit("sk_live_"), _mixed("v", 24))),
        "host_key": (1, F.concat(F.lit("ghp_"), _mixed("v", 36))),
        "bearer": (1, F.concat(F.lit("Authorization: Bearer "), jwt)),
        "login": (1, login),
        "hex_40": (0, _assigned(HARMLESS_KEYS, _hex("v", 40))),
        "hex_32": (0, _assigned(HARMLESS_KEYS, _hex("v", 32))),
        "hex_18": (0, _assigned(HARMLESS_KEYS, _hex("v", 18))),
        "mixed_40": (0, _assigned(HARMLESS_KEYS, _mixed("v", 40))),
        "mixed_14": (0, _assigned(HARMLESS_KEYS, _mixed("v", 14))),
        "uuid": (0, uuid),
        "page": (0, page),
        "file": (0, file),
        "mail": (0, mail),
        "release": (0, release),
        "loud": (0, loud),
        "name": (0, name),
        "stand_in": (0, _assigned(SECRET_KEYS, stand_in)),
        "moment": (0, moment),
        "phone": (0, phone),
        "number": (0, _digits("v", 16)),
    }


def labelled_findings(spark: SparkSession, per_shape: int = 400, without: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, label, shape: so many texts of every shape (but those left out)."""
    every = shapes()
    rows = spark.range(per_shape * len(every)).withColumnRenamed("id", "doc_id")
    number = F.pmod("doc_id", F.lit(len(every)))
    shape = text = label = None
    for k, (name, (is_secret, value)) in enumerate(every.items()):
        if name not in without:
            here = number == k
            shape = F.when(here, name) if shape is None else shape.when(here, name)
            text = F.when(here, value) if text is None else text.when(here, value)
            label = F.when(here, is_secret) if label is None else label.when(here, is_secret)
    around = [_one(f"w{i}", FILLER) for i in range(7)]
    whole = F.concat_ws(" ", *around[:4], text, *around[4:])
    found = rows.select("doc_id", whole.alias("text"), label.alias("label"), shape.alias("shape"))
    return found.filter("shape IS NOT NULL")
