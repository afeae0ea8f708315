"""Quality rules, line first: failing lines go, then texts that lose too much of themselves.

Column expressions only. Everything about a text is computed in its own row, so there is
no shuffle and no group that could be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import SEPARATORS, WORD_GAP

#: Phrases of notices and page furniture, compared in lower case, by language.
NOTICES = {
    "en": [
        "all rights reserved", "licensed under", "released under the", "terms of use",
        "terms of service", "privacy policy", "cookie policy", "accept cookies", "use cookies",
        "enable javascript", "javascript is disabled", "subscribe to our", "sign up for our",
        "follow us on", "share this", "copyright ©", "copyright (c)", "lorem ipsum",
    ],
    "de": [
        "alle rechte vorbehalten", "lizenziert unter", "veröffentlicht unter der",
        "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "datenschutzerklärung",
        "cookie-richtlinie", "cookies akzeptieren", "verwenden cookies", "javascript aktivieren",
        "javascript ist deaktiviert", "newsletter abonnieren", "newsletter anmelden",
        "folgen sie uns auf", "diesen beitrag teilen",
    ],
    "fr": [
        "tous droits réservés", "sous licence", "publié sous la licence",
        "conditions générales d'utilisation", "conditions d'utilisation",
        "politique de confidentialité", "politique de cookies", "accepter les cookies",
        "utilise des cookies", "activer javascript", "javascript est désactivé",
        "abonnez-vous à notre", "inscrivez-vous à notre", "suivez-nous sur", "partager cet article",
    ],
    "es": [
        "todos los derechos reservados", "bajo licencia", "bajo la licencia", "condiciones de uso",
        "términos de servicio", "política de privacidad", "política de cookies", "aceptar cookies",
        "utiliza cookies", "habilitar javascript", "javascript está desactivado",
        "suscríbete a nuestro", "regístrate en nuestro", "síguenos en", "compartir este artículo",
    ],
}
#: Words that open the entries of menus, by language.
MENUS = {
    "en": [
        "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next",
        "previous", "back to top", "skip to content", "read more", "click here", "contact us",
        "about us", "site map", "sitemap",
    ],
    "de": [
        "startseite", "menü", "anmelden", "einloggen", "registrieren", "suche", "weiter",
        "zurück", "nach oben", "zum inhalt springen", "weiterlesen", "mehr lesen", "hier klicken",
        "kontakt", "über uns", "impressum",
    ],
    "fr": [
        "accueil", "se connecter", "connexion", "s'inscrire", "rechercher", "suivant", "précédent",
        "haut de page", "aller au contenu", "lire la suite", "en savoir plus", "cliquez ici",
        "contactez-nous", "à propos de nous", "plan du site",
    ],
    "es": [
        "inicio", "menú", "iniciar sesión", "acceder", "registrarse", "buscar", "siguiente",
        "anterior", "volver arriba", "saltar al contenido", "leer más", "haz clic aquí",
        "contacto", "sobre nosotros", "mapa del sitio",
    ],
}
BOILERPLATE = [phrase for phrases in NOTICES.values() for phrase in phrases]
NAVIGATION = [phrase for phrases in MENUS.values() for phrase in phrases]
#: Marks that end a sentence or a quotation.
SENTENCE_ENDS = ".!?:;\"')]»”’…。！？"
SYMBOLS = "#*$%&|<>"
GAP = r"[\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return let(parts, lambda w: F.when(
        (F.get(w, 0) == "") | (F.get(w, F.size(w) - 1) == ""), F.filter(w, lambda x: x != "")
    ).otherwise(w))


#: Up to so many repeated windows are looked up one by one; more are found by sorting.
FEW_WINDOWS = 24


def _places_by_sorting(hashes: Column) -> Column:
    """Places of the windows that occur more than once, in order.

    The windows are sorted by (hash, place), which makes equal ones neighbours.
    """
    placed = F.sort_array(F.transform(
        hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))
    ))

    def repeated(s: Column) -> Column:
        places = F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["at"]
        ))
        return F.sort_array(F.filter(places, lambda x: x.isNotNull()))

    return let(placed, repeated)


def _places_of(hashes: Column, twice: Column) -> Column:
    """Places of the windows whose hash is in the short array ``twice``, in order."""
    places = F.transform(hashes, lambda h, at: F.when(F.array_contains(twice, h), at))
    return F.filter(places, lambda x: x.isNotNull())


def _covered(hashes: Column) -> Column:
    """Words covered by the windows whose hash occurs more than once.

    A place covers three words, or fewer up to the next place.
    """
    twice = let(F.sort_array(hashes), lambda s: F.array_distinct(
        F.filter(s, lambda x, j: F.get(s, j - 1) == x)
    ))

    def total(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, j: F.least(
                F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))
            )),
            F.lit(0), lambda a, x: a + x,
        )

    return let(twice, lambda t: F.when(F.size(t) == 0, F.lit(0)).otherwise(let(
        F.when(F.size(t) <= FEW_WINDOWS, _places_of(hashes, t)).otherwise(
            _places_by_sorting(hashes)
        ),
        total,
    )))


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text, the first included."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda at: F.xxhash64(F.get(words, at), F.get(words, at + 1), F.get(words, at + 2)),
    )
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(
        hashes,
        _covered,
    ))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _any_of(phrases: list[str]) -> str:
    return "|".join(phrase.replace("(", r"\(").replace(")", r"\)") for phrase in phrases)


OPENS = f"^({_any_of(NAVIGATION)})" + r"(\P{L}|$)"
ENDED = r"""[.!?:;。！？…]["')\]”’»]*$"""
MARK = r"[!-/:-@\[-`{-~]"
FEW_MARKS = 3
MENU_MARK = r"[|»›•·]"


def line_fails(line: Column, min_words: int = 4, max_marks: float = 0.2) -> Column:
    """Whether a line with words fails a rule.

    Punctuation: it has under ``min_words`` words and no sentence end, or over ``FEW_MARKS``
    and over ``max_marks`` of its characters are ASCII punctuation. Navigation: three menu marks, or
    under eight words that open with a menu word and reach no sentence end. Boilerplate: it
    holds a notice phrase. The words and phrases are those of all languages listed above,
    whatever the language of the text.
    """
    def fails(bare: Column, lowered: Column) -> Column:
        n_words = F.size(F.split(bare, WORD_GAP))
        ended = bare.rlike(ENDED)
        opens = lowered.rlike(OPENS)
        return (
            (F.regexp_count(bare, F.lit(MARK)) > F.greatest(
                F.lit(FEW_MARKS), F.lit(max_marks) * F.length(bare)
            ))
            | (~ended & ((n_words < min_words) | ((n_words < 8) & opens)))
            | (F.regexp_count(bare, F.lit(MENU_MARK)) >= 3)
            | _holds(lowered, BOILERPLATE)
        )

    return let(F.btrim(line, F.lit(SEPARATORS)),
               lambda bare: let(F.lower(bare), lambda lowered: fails(bare, lowered)))


def _holds(lowered: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | lowered.contains(phrase)
    return found


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_loss: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: its id, the cleaned text, counts and the verdict.

    Failing lines are taken out and the rest joined again (``clean_text``); lines without a
    word stay as they are. ``lost_chars`` are the characters of the lines taken out. A text
    is kept unless it fails the base rule (under ``min_words`` words, or over
    ``max_repeat_percent`` of its words in repeated 3-word windows) or loses more than
    ``max_loss`` of the characters of its lines.

    Null and empty texts have no words, fail the base rule and stay empty (null stays null).
    Only the two named columns are read, so other columns cannot clash; equal rows give
    equal rows; no row is dropped.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col), F.col(text_col).alias("text_"), words_of(F.col(text_col)).alias("words_"),
        F.transform(F.split(text, "\n"), lambda line: F.struct(
            line.alias("line"), _has_word(line).alias("solid"),
            F.when(_has_word(line), line_fails(line)).otherwise(False).alias("fails"),
        )).alias("lines_"),
    )
    whole = F.coalesce("text_", F.lit(""))
    counted = base.select(
        id_col, "text_", "lines_",
        F.size("words_").cast("long").alias("n_words"),
        (F.length(whole) - F.regexp_count(whole, F.lit(GAP))).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(F.transform(F.filter("lines_", lambda x: x["solid"]), lambda x: x["line"]),
            lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))
        .cast("long").alias("n_dup_lines"),
        let(F.col("words_"), repeat_words).cast("long").alias("n_repeat_words"),
        F.filter("lines_", lambda x: ~x["fails"]).alias("left_"),
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    chars = _chars(F.col("lines_"))
    lost = (chars - _chars(F.col("left_"))).cast("long")
    return counted.select(
        id_col,
        F.when(F.col("text_").isNotNull(), F.array_join(
            F.transform("left_", lambda x: x["line"]), "\n"
        )).alias("clean_text"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.size("lines_") - F.size("left_")).cast("long").alias("n_failed_lines"),
        chars.cast("long").alias("line_chars"), lost.alias("lost_chars"),
        failed.alias("base_failed"),
        (~failed & (lost <= max_loss * chars)).alias("kept"),
    )


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x["line"]))
