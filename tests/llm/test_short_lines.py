"""Lines under MIN_WORDS words in line dedup."""

import corpus_pipeline
from lumenmart.llm import lines

TEXTS = [
    "Title\n\nRed blue\none two three four five six\n漢字仮名交じり文の長い一行",
    "title \n\nred  BLUE\nred green\none two three four five seven\n漢字仮名交じり文の長い一行",
    "Red blue\n \nTitle\n漢字仮名交じり文の長い一行",
    "own words",
]
LEFT = [TEXTS[0], "\nred green", " ", "own words"]


def test_short_lines_go_by_equality(documents):
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.without_repeated_lines(documents(TEXTS), short=True).collect()}
    assert got == {i: (t, len(TEXTS[i].split("\n")) - len(t.split("\n"))) for i, t in enumerate(LEFT)}


def test_copies_leave_no_words_in_the_pipeline(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(TEXTS * 2)], schema)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert got == {0: LEFT[0], 1: LEFT[1], 3: LEFT[3]}


def test_long_lines_that_differ_in_one_word(documents):
    """The work grows with the words of a line, not with their square."""
    own = [f"w{i * 7919 % 100_003}" for i in range(100_000)]
    other = [*own[:60_000], "another", *own[60_001:]]
    shorter = own[:30_000] + own[30_001:]
    apart = [*own[:20_000], "x", *own[20_001:70_000], "y", *own[70_001:]]
    got = {r.doc_id: r.n_dropped for r in lines.without_repeated_lines(documents([" ".join(t) for t in (own, other, shorter, apart)])).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0}


def test_running_sums_of_all_lengths(spark, documents):
    prime, base = lines.PRIMES[1], lines.BASES[1]
    sizes = [1, 2, lines.SUMS - 1, lines.SUMS, lines.SUMS + 1, 2 * lines.SUMS, 2 * lines.SUMS + 3]
    rows = spark.createDataFrame([(n, [(i * 2654435761) % 2**63 - 2**62 for i in range(n)]) for n in sizes], "n int, hashes array<bigint>")
    for r in rows.select("n", "hashes", lines._running_sums(prime, base).alias("sums")).collect():
        want, total, power = [0], 0, 1
        for h in r.hashes:
            total, power = (total + h % prime * power) % prime, power * base % prime
            want.append(total)
        assert r.sums == want


def test_columns_with_the_operators_own_names(documents):
    df = documents(["one two three four five", "one two three four six"]).selectExpr("*", "1 as _id", "2 as _gone", "3 as _lines", "4 as _kept", "5 as _bits")
    got = sorted(tuple(r) for r in lines.without_repeated_lines(df).collect())
    assert got == [(0, "one two three four five", 1, 2, 3, 4, 5, 1, 0), (1, "", 1, 2, 3, 4, 5, 1, 1)]
