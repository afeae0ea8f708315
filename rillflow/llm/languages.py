"""Language identification: the family first, then one-versus-one machines within it.

Texts are described by the shares of their hashed byte trigrams. Linear support vector
machines part every two families and every two languages of a family; duels are counted,
first between families and then between the languages of the winner. Being linear in
shares, a duel over a whole text is the mean of the weights of its trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batched, held, slices, text_parts

#: Language codes by family. For other codes see ``grouped``.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["ar", "he", "mt"],
}
FEATURES = 1 << 13
UNDETERMINED = "und"
#: Other codes up to this number form a family of their own each; more share families of so many.
FAMILY_SIZE = 16
#: Rows of one side of a duel between families, taken evenly from its languages.
DUEL_ROWS = 1600

_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_FOLD = np.full(256, 32, np.int64)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True


def grouped(languages: list[str]) -> dict[str, list[str]]:
    """Families and their languages. Duels so grow with families squared plus languages."""
    families: dict[str, list[str]] = {}
    other = sorted(set(languages) - _FAMILY_OF.keys())
    shared = len(other) > FAMILY_SIZE
    for i, language in enumerate(other):
        name = f"others {i // FAMILY_SIZE:06d}" if shared else f"only {language}"
        families.setdefault(name, []).append(language)
    for language in sorted(set(languages) & _FAMILY_OF.keys()):
        families.setdefault(_FAMILY_OF[language], []).append(language)
    return families


@dataclass
class TrigramCounts:
    """Rows of trigram counts, kept as features and numbers; an array of indices takes them dense."""

    which: list[np.ndarray]
    numbers: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.which)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), FEATURES), np.float32)
        for i, row in enumerate(rows.tolist()):
            x[i, self.which[row]] = self.numbers[row]
        return x


def trigrams(data: np.ndarray) -> np.ndarray:
    """The feature of each byte trigram of a slice; letters folded, other ASCII as spaces."""
    folded = _FOLD[data]
    codes = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    return ((codes * 0x9E3779B1) >> 12) & (FEATURES - 1)


def _spans(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last trigram places of each text of a slice; none reaches into the next."""
    return at[:-1], np.maximum(at[1:] - 2, at[:-1])


@dataclass
class Machines:
    """Trained duels: (name, name) to weights and bias; positive is for the first."""

    languages: list[str]
    families: dict[str, list[str]] = field(default_factory=dict)
    duels: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)
    profile: Profile | None = None


@dataclass
class Profile:
    """What the trigrams of texts in any of the learned languages are like.

    ``logs`` are the log shares of features in the language where they are most frequent, so that
    a text of several languages is typical, too. Held-out texts have ``middle`` as the median of
    their mean log share; they stray from it by ``spread``, and short ones by ``one`` a trigram more.
    """

    logs: np.ndarray
    middle: float
    spread: float
    one: float

    def typicality(self, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How many deviations texts of ``n`` trigrams lie above (below: negative) the middle."""
        return (mean - self.middle) / np.sqrt(self.spread ** 2 + self.one ** 2 / np.maximum(n, 1))


def fit_profile(x: np.ndarray | TrigramCounts, labels: np.ndarray) -> Profile:
    """A profile from rows of trigram counts: half of each language's for the shares, half to measure."""
    best, held_out, spreads = None, [], []
    for language in np.unique(labels):
        own = np.flatnonzero(labels == language)
        known, rest = (own[::2], own[1::2]) if len(own) > 1 else (own, own)
        counts = x[known].sum(axis=0, dtype=np.float64)
        share = (counts + 0.5) / (counts.sum() + 0.5 * len(counts))
        logs = np.log(share)
        best = logs if best is None else np.maximum(best, logs)
        held_out.append(rest)
        spreads.append(np.sqrt((share * logs ** 2).sum() - (share * logs).sum() ** 2))
    means = []
    for rest in held_out:
        rows = x[rest]
        sizes = rows.sum(axis=1)
        means.append(rows[sizes > 0] @ best / sizes[sizes > 0])
    means = np.concatenate(means)
    if not len(means):
        return Profile(best, float(best.mean()), 1.0, float(np.mean(spreads)))
    middle = float(np.median(means))
    spread = 1.4826 * float(np.median(np.abs(means - middle)))
    return Profile(best, middle, max(spread, 0.05), float(np.mean(spreads)))


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 40
                  ) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge) by dual coordinate descent."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = np.einsum("ij,ij->i", x, x) + 0.5 / cost
    order = np.random.default_rng(5)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)).tolist():
            slope = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(0.0, alpha[i] - slope / diagonal[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]) * diagonal[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w[:-1], float(w[-1])


def _scale(x: np.ndarray | TrigramCounts, codes: np.ndarray) -> np.ndarray:
    """Factors that even out the spread of features, from sums language by language."""
    sums, squares = np.zeros(FEATURES), np.zeros(FEATURES)
    for language in np.unique(codes):
        shares = _shares(x[np.flatnonzero(codes == language)])
        sums += shares.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", shares, shares, dtype=np.float64)
    scale = 1 / np.sqrt(sums / len(x) + 1e-6)
    return scale / (np.sqrt((squares * scale ** 2).sum() / len(x)) + 1e-12)


def _shares(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)


def fit(x: np.ndarray | TrigramCounts, labels: list[str], languages: list[str]) -> Machines:
    """Machines for rows of trigram counts. Features are scaled by their spread first.

    Only the rows of one language, or of one duel, are dense at a time.
    """
    machines = Machines(languages, grouped(languages))
    if not len(x):
        return machines
    codes = np.array(labels)
    machines.profile = fit_profile(x, codes)
    scale = _scale(x, codes)
    rows_of = {language: np.flatnonzero(codes == language) for language in languages}

    def duel(one: str, two: str, rows: dict[str, np.ndarray]) -> None:
        y = np.repeat([1.0, -1.0], [len(rows[one]), len(rows[two])])
        chosen = np.r_[rows[one], rows[two]]
        w, b = train_machine((_shares(x[chosen]) * scale).astype(np.float32), y)
        machines.duels[one, two] = (w * scale, b)

    family_rows = {}
    for family, members in machines.families.items():
        own = np.concatenate([rows_of[language] for language in members])
        family_rows[family] = own[::-(-len(own) // DUEL_ROWS)] if len(own) else own
    for one, two in combinations(sorted(machines.families), 2):
        duel(one, two, family_rows)
    for members in machines.families.values():
        for one, two in combinations(sorted(members), 2):
            duel(one, two, rows_of)
    return machines


def _winners(names: list[str], margins: dict[tuple[str, str], np.ndarray], rows: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """The name with most duels won (ties: the larger sum of margins), and its weakest margin."""
    if len(names) == 1:
        return np.zeros(rows, np.int64), np.full(rows, np.inf)
    wins, sums = np.zeros((rows, len(names))), np.zeros((rows, len(names)))
    least = np.full((rows, len(names)), np.inf)
    for i, j in combinations(range(len(names)), 2):
        m = margins[names[i], names[j]]
        for k, own in ((i, m), (j, -m)):
            wins[:, k] += own > 0
            sums[:, k] += own
            least[:, k] = np.minimum(least[:, k], own)
    best = (wins + sums / (1 + np.abs(sums).max(axis=1, keepdims=True)) / 2).argmax(axis=1)
    return best, least[np.arange(rows), best]


def _margins(machines: Machines, names: list[str], grams: np.ndarray, first: np.ndarray,
             last: np.ndarray) -> dict[tuple[str, str], np.ndarray]:
    """The margins of all duels between ``names`` for texts given by their spans of trigrams."""
    margins = {}
    for pair in combinations(names, 2):
        weights, bias = machines.duels[pair]
        sums = np.r_[0.0, np.cumsum(weights[grams])]
        margins[pair] = (sums[last] - sums[first]) / np.maximum(last - first, 1) + bias
    return margins


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(3 * margin, -50, 50)))


def predict_slice(machines: Machines, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Languages and scores of the texts of a slice."""
    data, at = text_parts(column)
    rows = len(column)
    letters = np.r_[0, np.cumsum(_IS_LETTER[data])]
    lettered = letters[at[1:]] > letters[at[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(at) > 0)).tolist():
        lettered[i] = any(map(str.isalpha, column[i].as_py()))
    if not machines.languages or not rows:
        return [UNDETERMINED] * rows, np.zeros(rows)
    grams = trigrams(data) if len(data) > 2 else np.zeros(0, np.int64)
    first, last = (np.minimum(edge, len(grams)) for edge in _spans(at))
    families = sorted(machines.families)
    won, margin = _winners(families, _margins(machines, families, grams, first, last), rows)
    score = _sure(margin)
    found = np.full(rows, UNDETERMINED, object)
    for k, family in enumerate(families):
        mine = np.flatnonzero(won == k)
        if not len(mine):
            continue
        members = sorted(machines.families[family])
        # The trigrams of the family's own texts, side by side.
        sizes = last[mine] - first[mine]
        edges = np.r_[0, np.cumsum(sizes)]
        own = grams[np.arange(edges[-1]) + np.repeat(first[mine] - edges[:-1], sizes)]
        margins = _margins(machines, members, own, edges[:-1], edges[1:])
        best, weakest = _winners(members, margins, len(mine))
        found[mine] = np.array(members, object)[best]
        score[mine] *= _sure(weakest)
    found[~lettered] = UNDETERMINED
    score[~lettered] = 0.0
    return found.tolist(), np.round(score, 6)


def typicality_slice(machines: Machines, column: pa.Array) -> np.ndarray:
    """How typical the texts of a slice are of all learned languages; 0 without trigrams."""
    if machines.profile is None:
        return np.zeros(len(column))
    data, at = text_parts(column)
    first, last = _spans(at)
    grams = trigrams(data) if len(data) > 2 else np.zeros(0, np.int64)
    sums = np.r_[0.0, np.cumsum(machines.profile.logs[grams])]
    first, last = np.minimum(first, len(grams)), np.minimum(last, len(grams))
    n = last - first
    mean = (sums[last] - sums[first]) / np.maximum(n, 1)
    return np.where(n > 0, machines.profile.typicality(mean, n), 0.0)


def train(docs: DataFrame, trains: Column, id_col: str, text_col: str, lang_col: str,
          per_language: int = 400, most_rows: int = 20_000, seed: int = 11) -> Machines:
    """Machines learned from labelled rows where ``trains`` holds.

    Bound: about ``per_language`` rows of every language, and fewer of each where that would be
    more than ``most_rows`` together, drawn by a hash of id and text. No language is left out for
    being rare, unless there are more languages than ``most_rows``: then some draw no row. Only the
    trigram counts of drawn rows reach the driver, equal rows once.
    """
    labelled = docs.filter(trains & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    lang = F.col(lang_col).cast("string")
    counts = held(labelled.groupBy(lang.alias("known_")).agg(F.count("*").alias("rows_")), "languages")
    number = counts.count()
    if not number:
        return Machines([])
    share = F.lit(min(float(per_language), most_rows / number)) / F.col("rows_")
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    drawn = labelled.select(lang.alias("lang_"), draw.alias("draw_"), F.col(text_col).alias("text_")).join(
        counts, F.col("lang_") == F.col("known_")
    ).filter(F.pmod("draw_", F.lit(1 << 40)) / float(1 << 40) < share).select(
        "lang_", "draw_", "text_"
    ).dropDuplicates(["lang_", "draw_"])
    schema = T.StructType([
        T.StructField("lang_", T.StringType()), T.StructField("draw_", T.LongType()),
        T.StructField("grams", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            data, at = text_parts(batch.column("text_"))
            grams = trigrams(data) if len(data) > 2 else np.zeros(0, np.int64)
            which, numbers = [], []
            for start, end in zip(*(x.tolist() for x in _spans(at))):
                total = np.bincount(grams[start:end], minlength=FEATURES)
                own = np.flatnonzero(total)
                which.append(own.astype(np.uint16).tobytes())
                numbers.append(total[own].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang_"), batch.column("draw_"), pa.array(which, pa.binary()),
                 pa.array(numbers, pa.binary())], names=schema.names,
            )

    found = sorted(batched(drawn).mapInArrow(describe, schema).collect(), key=lambda r: (r["lang_"], r["draw_"]))
    x = TrigramCounts(
        [np.frombuffer(row["grams"], np.uint16) for row in found],
        [np.frombuffer(row["counts"], np.uint32) for row in found],
    )
    labels = [row["lang_"] for row in found]
    return fit(x, labels, sorted(set(labels)))


def identify(
    docs: DataFrame, machines: Machines, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (), typicality: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, the columns of ``keep``, lang_pred and score.

    With ``typicality`` there is a column of that name: deviations by which the text's trigrams
    are more (negative: less) usual than those of learned texts, whatever their language. Dumps
    of numbers, random letters and languages never learned lie far below.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or
    has no letter, or nothing was learned. ``score`` (0 to 1) multiplies how surely the
    winner won its closest duel among families and among languages. Whole texts are read;
    a text under three bytes falls to the biases. Equal texts give equal results; names of
    results in ``keep`` are an error. The machines travel with the tasks: 64 KB for every two
    families and every two languages of a family.
    """
    names = list(dict.fromkeys([id_col, *keep]))
    results = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if typicality:
        results.append(T.StructField("typicality", T.DoubleType()))
    if clash := {field.name for field in results} & set(names):
        raise ValueError(f"names of results can't be kept: {sorted(clash)}")
    schema = T.StructType([docs.schema[name] for name in names] + results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(text_col)
            found, score = predict_slice(machines, texts)
            columns = [batch.column(name) for name in names] + [pa.array(found), pa.array(score)]
            if typicality:
                columns.append(pa.array(typicality_slice(machines, texts)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return batched(docs.select(*dict.fromkeys([*names, text_col]))).mapInArrow(run, schema)
