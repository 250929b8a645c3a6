import re
from collections import Counter, defaultdict

from waybill.llm import quality

COLUMNS = "doc_id long, text string, source string, extra int"


def brute(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    normal = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" ")
    hosts, holders = defaultdict(set), defaultdict(set)
    for _, text, source, _ in rows:
        hosts[source or ""].add(text or "")
        for line in (text or "").split("\n"):
            if word.search(line):
                holders[source or "", normal(line)].add(text or "")
    out = []
    for doc, text, source, _ in rows:
        words, lines = word.findall(text or ""), [x for x in (text or "").split("\n") if word.search(x)]
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often, covered = Counter(grams), set()
        for i, g in enumerate(grams):
            if often[g] > 1:
                covered |= {*range(i, i + 5)}
        common = [x for x in lines if len(h := holders[source or "", normal(x)]) > quality.LINE_DOCS and 100 * len(h) > quality.LINE_PERCENT * len(hosts[source or ""])]
        n, gone = len(words), sum(len(word.findall(x)) for x in common)
        failed = n < 10 or 100 * len(covered) > 20 * n
        depleted = gone > 0 and (n - gone < 10 or 100 * (n - gone) < 30 * n)
        out.append((doc, n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed, gone, not failed and not depleted))
    return sorted(out, key=str)


def rows_of(spark, rows):
    return sorted([tuple(r) for r in quality.judged(spark.createDataFrame(rows, COLUMNS)).collect()], key=str)


def test_measures_and_verdicts(spark):
    story = "one two three four five six seven eight nine ten eleven twelve"
    footer = "Read MORE  on page 12 of our site today dear reader"
    rows = [(i, f"{story} {i}\n{footer}", "a", 1) for i in range(60)]
    rows += [(100 + i, f"{footer.replace('12', str(i + 10))}\nx{i}", "a", 1) for i in range(3)]
    rows += [(200, None, "a", 1), (201, "", None, 1), (202, "é ñ ß\n\n#*|", None, None), (203, " \t\n", "b", 1), (None, story, "b", 1), (204, story, "b", 1), (204, story, "b", 1)]
    rows += [(300, "a b c d e a b c d e f g h i j k l m n o p q r s t u v w x y z", "b", 1), (301, "x " * 5000, "c", 1), (302, "same line\nsame line\nother", "c", 1)]
    got = rows_of(spark, rows)
    assert got == brute(rows)
    verdict = {r[0]: r[-1] for r in got}
    assert verdict[0] and not verdict[100]  # a footer with a story stays, a footer alone goes


def test_empty_table(spark):
    assert rows_of(spark, []) == []


def test_lines_taken_out(spark):
    rows = [(i, f"story {i}\nfooter line\nend {i}", "a", i) for i in range(60)] + [(60, None, "a", 0), (61, "footer line", "b", 0)]
    out = {r.doc_id: (r.text, r.extra) for r in quality.cleaned(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert out[3] == ("story 3\nend 3", 3) and out[60] == (None, 0) and out[61] == ("footer line", 0)


def test_no_python_in_plan(spark):
    plan = quality.judged(spark.createDataFrame([(1, "a", "b", 1)], COLUMNS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table(spark, tmp_path):
    import duckdb

    docs = duckdb.sql("select doc_id, text, source, 1 from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert rows_of(spark, docs) == brute(docs)
