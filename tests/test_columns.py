import mimetypes
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborsync.functions import content, keys, masking, mime, urls

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def lit(*values):
    return [F.lit(v) for v in values]


def one(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


def test_config_hash_golden(spark):
    assert one(spark, keys.config_hash(*lit("https://x", "main", "", ""))) == "8428543dbf439fac"
    assert one(spark, keys.config_hash(*lit("https://x", None, None, None))) == "8428543dbf439fac"
    assert one(spark, keys.config_hash(*lit("https://x", "", "", " , "))) == "8428543dbf439fac"


def test_config_hash_spellings(spark):
    def key(function, subdir, extensions):
        return one(spark, function(*lit("u", "main", subdir, extensions)))

    assert key(keys.config_hash, "", ".md,.txt") == key(keys.config_hash, "", " .TXT ,.md")
    assert key(keys.config_hash, "", "md") != key(keys.config_hash, "", ".md")
    assert key(keys.config_hash, "docs", "") != key(keys.config_hash, "docs/", "")
    assert key(keys.source_key, "docs", "md") == key(keys.source_key, "/docs/ ", ".MD,md")


def test_storage_key(spark, evaluate):
    made = one(spark, keys.storage_key(*lit(" u ", None, "/docs/", " .MD ")))
    assert made == one(spark, keys.storage_key(*lit("u", "main", "docs", ".md")))
    assert re.fullmatch("git_browse:[0-9a-f]{16}", made)
    audit = [made, made[:-1], made + ":x", "git_sha:" + "0" * 16, "git_browse:" + "g" * 16, "git_browse:" + "A" * 16, "", None]
    assert evaluate(audit, keys.is_storage_key) == [True, False, False, False, False, True, False, False]
    assert evaluate(["a:b:c", "abc", ""], keys.storage_key_prefix) == ["a", "", ""]
    assert evaluate(["a:b:c", "abc", ""], keys.storage_key_hash) == ["b:c", "abc", ""]


VALID = [
    "https://example.com/u/r.git", "http://example.com:8080/u/r", "https://git.example.com/u/r",
    "git@example.com:u/r.git", "ssh://git@example.com/u/r.git", "ssh://example.com:22/u/r", "/srv/r", "file:///srv/r",
    "  https://example.com/u/r  ", "/srv/r\n",
]


def test_url_audit(evaluate):
    assert evaluate(VALID, urls.url_error) == [""] * len(VALID)
    wrong = ["", None, "git://h/r", "user@host", "ftp://h/r", "https://", " ", "a@b@c:d", "x y"]
    assert evaluate(wrong, urls.url_error) == [
        urls.URL_REQUIRED, urls.URL_REQUIRED, urls.GIT_PROTOCOL, urls.BAD_SSH, urls.BAD_URL, urls.BAD_URL,
        urls.BAD_URL, urls.BAD_SSH, urls.BAD_URL,
    ]


def test_url_types_and_names(evaluate):
    values = VALID + ["git://h/r", "", None]
    kinds = ["https"] * 3 + ["ssh"] * 3 + ["local"] * 2 + ["https", "local", "unknown", "unknown", "unknown"]
    assert evaluate(values, urls.url_type) == kinds
    assert evaluate(["file:///srv/r", "git@h:r", "nope"], urls.requires_clone) == [False, True, None]
    assert evaluate(["file:///srv/r", "git@h:r"], urls.clone_location) == ["/srv/r", "git@h:r"]
    names = ["https://h/u/r.git", "git@h:r.git", "git@h:u/r", "https://h/u/", "r", "", None, " /srv/r.git "]
    assert evaluate(names, urls.repo_name) == ["r", "r", "r", "", "r", "unknown", "unknown", "r"]


def model_mask_url(text):
    head, mark, rest = text.partition("://")
    authority, slash, tail = rest.partition("/")
    if not mark or "@" not in authority:
        return text
    return f"{head}://***:***@{authority.rpartition('@')[2]}{slash}{tail}"


@FEW
@given(st.lists(st.lists(st.sampled_from(["://", "/", "@", "a", ":", "é", " ", "\n"]), max_size=9).map("".join), min_size=80, max_size=160))
def test_mask_url_model(evaluate, values):
    assert evaluate(values, masking.mask_url) == [model_mask_url(v) for v in values]


def test_masking(evaluate, spark):
    assert evaluate(["", None, "12345678", "ghp_abcdefwxyz"], masking.mask_token) == ["***", "***", "***", "ghp_****wxyz"]
    text = ["ab tok tokens"]
    assert evaluate(text, lambda c: masking.mask_secrets(c, ["tok", "tokens"])) == ["ab *** ***ens"]
    assert evaluate(text, lambda c: masking.mask_secrets(c, ["tok", "tokens"], longest_first=True)) == ["ab *** ***"]
    line = ["clone https://u:pw@h/r and https://u:x@h2/r"]
    assert evaluate(line, lambda c: masking.mask_log_line(c, ["x"])) == ["clone https://***:***@h/r and https://u:***@h2/r"]
    assert evaluate(line, masking.mask_every_url) == ["clone https://***:***@h/r and https://***:***@h2/r"]


def test_mask_columns(spark):
    row = spark.sql(
        "select 'u' as user, 'p' as PASSWORD, '' as secret, 0 as token_count, 5 as api_keys,"
        " named_struct('private_key', 'k', 'inner', named_struct('secret_x', true, 'y', 1)) as nested,"
        " map('my_token', 't', 'z', 'w', 'secret', '') as m, array('a') as secret_list, map('k', map('password', 'x')) as deep,"
        " map('api_key', 12345, 'n', 7) as numbers, map('token', array('t'), 'l', array('v')) as lists,"
        " map('secret', map('x', 'y'), 'open', map('x', 'y')) as maps, map(1, 'kept') as by_number"
    )
    got = masking.mask_columns(row).first().asDict(recursive=True)
    assert got == {
        "user": "u", "PASSWORD": "***", "secret": "", "token_count": "0", "api_keys": "***",
        "nested": {"private_key": "***", "inner": {"secret_x": "***", "y": 1}},
        "m": {"my_token": "***", "z": "w", "secret": ""}, "secret_list": "***", "deep": {"k": '{"password":"***"}'},
        "numbers": {"api_key": "***", "n": "7"}, "lists": {"token": "***", "l": '["v"]'},
        "maps": {"secret": "***", "open": '{"x":"y"}'}, "by_number": {1: "kept"},
    }


def model_mime(path):
    suffix = "." + path.rsplit(".", 1)[-1].lower() if "." in path else ""
    if suffix in mime.FIRST_TYPES:
        return mime.FIRST_TYPES[suffix]
    return mimetypes.MimeTypes(filenames=()).guess_type(path)[0] or "text/plain"


def test_mime_types(spark):
    names = [
        "a.md", "A.MD", "d/x.tar.gz", "x.tgz", "x.json.gz", "x.gz", ".bashrc", ".md", "a.b/c", "a.md/b", "noext", "",
        "x.py", "x.PNG", "x.html", "x.svgz", "x.css.Z", "x.css.z", "..a.txt", "x.", "x.unknown", "a/.hidden.js", "x.tar.bz2", "x.txz",
    ]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r["path"]: r["mime_type"] for r in mime.with_mime_type(files).collect()}
    assert got == {n: model_mime(n) for n in names}
    preferred = {r["mime_type"]: r["extension"] for r in mime.preferred_extensions(spark).collect()}
    assert preferred["text/markdown"] == ".md" and preferred["text/yaml"] == ".yaml"
    standard = mimetypes.MimeTypes(filenames=())
    for kind in ("text/html", "image/jpeg", "text/plain", "application/x-tar", "text/x-python"):
        assert preferred[kind] == standard.guess_extension(kind)


def test_content_classes(evaluate):
    samples = [
        b"\x89PNG\r\n", b"\xff\xd8\xff\xe0", b"GIF89a", b"PK\x03\x04x", b"%PDF-1", b"\x7fELF", b"MZ text", b"a\x00b",
        b"x" * 8191 + b"\x00", b"x" * 8192 + b"\x00", "привет".encode(), b"", b"\xef\xbb\xbfbom", b"\xff", b"\xc3",
    ]
    rows = [bytearray(s) for s in samples]
    assert evaluate(rows, lambda c: content.is_binary(c, content.SNIFF_BYTES), "binary") == [True] * 9 + [False] * 6
    assert evaluate(rows, content.is_binary, "binary") == [True] * 10 + [False] * 5
    assert evaluate(rows[9:], content.is_utf8, "binary") == [True] * 4 + [False] * 2
    assert evaluate([bytearray("é﻿".encode())], lambda c: content.decode_utf8(c).cast("string"), "binary") == ["é﻿"]


def test_read_outcome_order(spark):
    rows = [
        (bytearray(b"ok"), True, None), (None, False, None), (None, True, "io"), (bytearray(b"MZ\xff"), True, None),
        (bytearray(b"a\xff"), True, None), (bytearray("é".encode() * 6), True, None), (bytearray(b"x" * 10), True, None),
    ]
    df = spark.createDataFrame(rows, "c binary, found boolean, e string").coalesce(1)
    outcome = content.read_outcome(F.col("c"), F.col("found"), F.col("e"), 10)
    got = [r["o"] for r in df.select(outcome.alias("o")).collect()]
    assert got == ["ok", "not_found", "read_error", "binary", "non_utf8", "too_large", "ok"]


def test_skip_reasons(spark):
    rows = [
        (".git/config", 1, "100644"), ("a\\.git\\x", 1, "120000"), ("a.git/x", 1, "120000"), ("l", 9, "100644"),
        ("ok", 5, "100644"), (".gitignore", 5, "100644"),
    ]
    df = spark.createDataFrame(rows, "path string, size long, mode string").coalesce(1)
    reason = content.skip_reason(F.col("path"), F.col("size"), F.col("mode"), 5)
    assert [r["r"] for r in df.select(reason.alias("r")).collect()] == [
        "git_directory", "git_directory", "symlink", "too_large", None, None,
    ]
