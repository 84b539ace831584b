import fnmatch

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborsync.functions import paths

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
PART = st.text(alphabet="ab_.-~D é", min_size=1, max_size=5)
PATH = st.lists(PART, min_size=1, max_size=4).map("/".join)
UGLY = st.lists(st.sampled_from(["./", "/", "\\", "..", "a", "b.md", "notes..md", "."]), max_size=7).map("".join)


def model_normalize(path):
    path = path.replace("\\", "/").lstrip("/")
    while path[:2] == "./":
        path = path[2:]
    return path


def test_normalize_examples(evaluate):
    given_paths = ["a\\b.md", "./a.md", "././a.md", "/a.md", "///a.md", "/./t.py", ".//x", "./", "a/../b", "notes..md"]
    expected = ["a/b.md", "a.md", "a.md", "a.md", "a.md", "t.py", "/x", "", "a/../b", "notes..md"]
    assert evaluate(given_paths, paths.normalize_path) == expected
    assert evaluate(expected, paths.has_traversal) == [False] * 8 + [True, False]


@FEW
@given(st.lists(UGLY, min_size=50, max_size=150))
def test_normalize_model(evaluate, values):
    normalized = [model_normalize(v) for v in values]
    assert evaluate(values, paths.normalize_path) == normalized
    assert evaluate(normalized, paths.has_traversal) == [".." in n.split("/") for n in normalized]


def test_parse_extensions():
    assert paths.parse_extensions(".md,.txt") == [".md", ".txt"]
    assert paths.parse_extensions(" MD , txt,,") == [".md", ".txt"]
    assert paths.parse_extensions("md,md") == [".md", ".md"]
    assert paths.parse_extensions("") == paths.parse_extensions(None) == paths.parse_extensions(" , ") == []


@FEW
@given(st.lists(st.text(alphabet="mMdT.x, \t\n", max_size=12), min_size=50, max_size=100))
def test_extension_column_agrees_with_literal_form(evaluate, settings_given):
    assert evaluate(settings_given, paths.extension_array) == [paths.parse_extensions(s) for s in settings_given]


def test_extension_suffix(evaluate):
    names = ["a.tar.gz", "A.MD", ".md", "md", "a_md", "x%md", "a.mdx"]
    assert evaluate(names, lambda c: paths.has_extension(c, [".gz", "md"])) == [
        True, True, True, False, False, False, False,
    ]
    assert evaluate(names, lambda c: paths.has_extension(c, [])) == [True] * 7
    assert evaluate(names, lambda c: paths.has_extension(c, F.array(F.lit(".gz")))) == [True] + [False] * 6


@FEW
@given(
    st.lists(st.one_of(PATH, PATH.map(lambda p: "/" + p), PATH.map(lambda p: "docs/" + p)), min_size=50, max_size=100),
    st.sampled_from(["docs", "/docs/", " docs/ ", "docs/a", "", " ", "/", "a"]),
)
def test_subdir_model(evaluate, values, subdir):
    prefix = subdir.strip().strip("/")
    expected = [not prefix or v.lstrip("/").startswith(prefix + "/") for v in values]
    assert evaluate(values, lambda c: paths.in_subdir(c, subdir)) == expected
    assert evaluate(values, lambda c: paths.in_subdir(c, F.lit(subdir))) == expected
    below = [
        v.lstrip("/")[len(prefix) + 1 :] if prefix and inside else v for v, inside in zip(values, expected)
    ]
    assert evaluate(values, lambda c: paths.relative_path(c, subdir)) == below


def test_subdir_is_a_whole_component(evaluate):
    assert evaluate(["docs2/x", "docs/x", "/docs/x", "docs"], lambda c: paths.in_subdir(c, "docs")) == [
        False, True, True, False,
    ]


def model_excluded(path, patterns):
    return any(
        fnmatch.fnmatchcase(candidate, shape)
        for p in patterns
        for candidate, shapes in [(path, (p, f"*/{p}", f"{p}/*", f"*/{p}/*"))] + [(c, (p,)) for c in path.split("/")]
        for shape in shapes
    )


@FEW
@given(
    st.lists(PATH, min_size=60, max_size=120),
    st.lists(
        st.sampled_from([".*", "a*", "*b", "?", "[ab]*", "[!a]", "a/b", "*.md", "a/*", "_", "(", "a.b", "[]a]", "[", "a-b"]),
        min_size=1, max_size=3,
    ),
)
def test_exclude_model(evaluate, values, patterns):
    expected = [model_excluded(v, patterns) for v in values]
    assert evaluate(values, lambda c: paths.is_excluded(c, patterns)) == expected


def test_exclude_examples(evaluate):
    values = ["a/node_modules/x.js", ".github/x.yml", "src/.env", "src/main.py", "a\n/b", "node_modules"]
    got = evaluate(values, lambda c: paths.is_excluded(c, paths.parse_patterns(" .* , node_modules,")))
    assert got == [True, True, True, False, False, True]


def test_subdir_reaches_the_scan(spark, tmp_path):
    from arborsync.operators.snapshot import list_files

    rows = [("r", "c", f"docs/{i}.md", "100644", str(i), i) for i in range(5)]
    spark.createDataFrame(rows, "repo_id string, commit_sha string, path string, mode string, blob_sha string, size long").write.parquet(
        str(tmp_path / "t")
    )
    plan = list_files(spark.read.parquet(str(tmp_path / "t")), subdir="docs")._jdf.queryExecution().toString()
    assert "StringStartsWith(path,docs/)" in plan
    assert "blob_sha" not in plan.split("ReadSchema")[-1]
