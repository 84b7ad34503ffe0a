import random
import textwrap

from versus.llm import licenses as lic


def test_ranking_and_differences():
    s = lic.Scanner(lic.TEMPLATES)
    for name, text in lic.TEMPLATES.items():
        assert s.rank(text)[0][0] == name
        hits = s.scan(f"first line\n{text}\nlast")
        assert [(h[0], h[1], h[2], h[4], h[5]) for h in hits] == [(name, 1, 1, [], [])]
    changed = lic.TEMPLATES["isc"].replace("any purpose", "every good purpose")
    (hit,) = s.scan(changed)
    assert hit[0] == "isc" and hit[4] == ["any"] and hit[5] == ["every", "good"]
    assert s.scan("copyright is a word of law, and permission is one of manners") == []
    inside = "word " * 3000 + lic.TEMPLATES["mit"] + " word" * 3000
    assert [h[0] for h in s.scan(inside)] == ["mit"]


def test_query_finds_every_planted_line(spark, data_dir):
    got = {r.doc_id: r for r in lic.op9_licenses(spark, data_dir).collect()}
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    names = {v: k for k, v in lic.TEMPLATES.items()}
    for d in docs:
        want = [f"{names[x]}:{i}:{i}:0:0" for i, x in enumerate(d.text.split("\n")) if x in names]
        assert set(want) <= set(got[d.doc_id].matches.split(","))
        if not want:
            assert got[d.doc_id].n_matches == 0


def test_odd_rows(spark):
    rows = [(1, None, 2), (2, "", 2), (None, "All rights reserved.", 1), (3, "x " * 50000, 1), (3, "x " * 50000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_blocks int")
    got = [(r.doc_id, r.n_blocks, len(r.matches)) for r in lic.scan_licenses(df).collect()]
    assert got == [(1, 0, 0), (2, 0, 0), (None, 1, 1), (3, 0, 0), (3, 0, 0)]
    assert lic.scan_licenses(df.limit(0)).collect() == []


def test_many_notices_in_a_block():
    s = lic.Scanner(lic.TEMPLATES)
    gpl = lic.TEMPLATES["gpl-3.0"]
    assert [h[0] for h in s.scan(f"{gpl}\nAll rights reserved.")] == ["gpl-3.0", "all-rights-reserved"]
    for text in ("\n".join(lic.TEMPLATES.values()), " ".join(lic.TEMPLATES.values())):
        assert [h[0] for h in s.scan(text)] == list(lic.TEMPLATES)
    many = "\n".join(["All rights reserved.", lic.TEMPLATES["mit"]] * 200)
    hits = s.scan(many)
    assert [(h[0], h[1], h[2]) for h in hits] == [(["all-rights-reserved", "mit"][i % 2], i, i) for i in range(400)]


def test_wrapped_notices():
    s = lic.Scanner(lic.TEMPLATES)
    for width in (20, 70):
        for name, text in lic.TEMPLATES.items():
            lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
            hits = s.scan("\n".join(["A line before.", *(f"# {x}" for x in lines), "A line after."]))
            assert [(h[0], h[1], h[2], h[4], h[5]) for h in hits] == [(name, 1, len(lines), [], [])]
    assert s.scan("All is well " + "so far " * 20 + "\nrights reserved for no one") == []


def exhaustive(scanner):
    """The same scanner with every template a candidate everywhere, by differences alone."""
    scanner.candidates = lambda words: [(0, name) for name in scanner.words]
    return scanner


def mutated(seed, n):
    rng = random.Random(seed)
    filler = "the of a work may text license any copyright notice public rights under is".split()
    for _ in range(n):
        parts = []
        for name in rng.sample(sorted(lic.TEMPLATES), rng.randrange(1, 4)):
            words = lic.TEMPLATES[name].split()
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["changed"], [words[at], "more"]])
            parts += [" ".join(rng.choices(filler, k=rng.randrange(30))), " ".join(words)]
        yield rng.choice([" ", "\n"]).join([*parts, "end"])


def test_ranking_against_the_exhaustive_comparison(spark, data_dir):
    """Nothing is lost in the documents; of notices with changed wording, which compression may
    not tell from noise, one in twenty at most."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("text").collect()
    ranked, every = lic.Scanner(lic.TEMPLATES), exhaustive(lic.Scanner(lic.TEMPLATES))

    def both(texts):
        for text in texts:
            yield tuple({(h[0], h[1], h[2]) for h in s.scan(text)} for s in (ranked, every))

    assert all(a == b for a, b in both(d.text or "" for d in docs))
    pairs = list(both(mutated(1, 300)))
    found, lost = sum(len(b) for _, b in pairs), sum(len(b - a) for a, b in pairs)
    assert found > 500 and lost <= 0.05 * found


def test_nothing_is_found_without_the_ranking():
    s = lic.Scanner(lic.TEMPLATES)
    s.given_words = {name: s.alone for name in s.words}  # dictionaries that save nothing
    assert all(s.scan(text) == [] for text in lic.TEMPLATES.values())


def test_noise_is_no_candidate():
    s = lic.Scanner(lic.TEMPLATES)
    for name, text in lic.TEMPLATES.items():
        words = lic._WORD.findall(text.lower())
        assert s.candidates(words)[0][1] == name
        assert name not in [c for _, c in s.candidates(sorted(words))] or words == sorted(words)
