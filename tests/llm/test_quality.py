from collections import Counter

from helpers import PROSE, WORD, frame, odd_rows, row

from rillflow.llm import quality


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    solid = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(solid) - len(set(solid)), len(covered), failed,
    )


def test_counts(spark):
    rows = odd_rows() + [
        row(100, "a b c a b c"), row(101, "a a a a a"), row(102, "x " * 500), row(103, "a b\nb a\n\na b"),
        row(104, " ".join(f"w{i % 40} v{i % 7}" for i in range(3000))),
        row(105, "\n".join(["# * $ % & | < >", "same line", "same line", " ", "same line "])),
    ]
    found = quality.line_quality(frame(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    want = [(r[0], *base(r[1])) for r in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert quality.line_quality(frame(spark, [])).count() == 0


def test_lines(spark):
    long = "\n".join(
        f"Sentence number {i} says something {i * 7} else about {i * 3} things." for i in range(12)
    )
    bad = [
        "Home | About | Contact | Help", "Read more", "All rights reserved, see the Terms of Use.",
        "*** ### $$$ %%% &&&", "Click here to go on", "Short",
    ]
    good = ["Is this one kept?", "“It ends well.”", "a line of five words", "", "Ja."]
    df = frame(spark, [row(1, "\n".join([*bad[:3], long, *good, *bad[3:]])), row(2, long), row(3, PROSE),
                       row(4, "\n".join(bad * 40) + "\n" + long)])
    found = {r["doc_id"]: r for r in quality.line_quality(df).collect()}
    assert found[1]["clean_text"] == "\n".join([long, *good])
    assert found[1]["n_failed_lines"] == len(bad)
    assert found[1]["kept"] and found[2]["kept"] and found[2]["lost_chars"] == 0
    assert found[3]["base_failed"] and not found[3]["kept"]
    assert not found[4]["kept"]
    plan = quality.line_quality(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_lines_of_other_languages(spark):
    bad = [
        "Alle Rechte vorbehalten, siehe unsere Datenschutzerklärung.", "Über uns und unsere Geschichte hier",
        "Zurück zur Übersicht der letzten Beiträge", "Tous droits réservés par les auteurs du site.",
        "Lire la suite de cet article ici", "À propos de nous et du site",
        "Lisez nos conditions d'utilisation avant de continuer.", "Este sitio utiliza cookies propias y de terceros.",
        "Menú principal de todas las páginas", "Leer más sobre este tema aquí",
    ]
    good = [
        "Der Kontaktmann wohnt weit draußen am Fluss", "Die Suche nach dem alten Haus dauerte viele Jahre lang an",
        "Le menuisier travaille encore dans son atelier", "Suivante dans la file, elle attendait son tour",
        "El anterioridad no cuenta en esta casa vieja", "Buscaron la casa junto al río.",
    ]
    text = "\n".join([*bad, *good])
    found = quality.line_quality(frame(spark, [row(1, text)])).first()
    assert found["clean_text"] == "\n".join(good)


def test_menu_words_end_where_words_end(spark):
    lines = ["Homeß is a word of five", "Menüs gibt es in allen guten Häusern", "Homepage of the old house there"]
    found = quality.line_quality(frame(spark, [row(1, "\n".join(lines))])).first()
    assert found["n_failed_lines"] == 0
