"""Problem 5: scoring texts for insults, threats, hatred and explicit sexual content.

A weighted lexicon is matched by one Aho-Corasick automaton after folding: compatibility
forms, invisible characters, accents, look-alike letters, digits for letters, masked letters,
spelled-out and stretched words. The lexicon is general vocabulary; phrases that a bounded sample of
labelled texts shows to be abusive only are added with small weights. Phrases of harmless use are
masked first. Scores are normalised by length: a text's score is the weight of its densest stretch
of WINDOW words, relative to the stretch's length, and its rate the weight per hundred words of it all.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("insult", "threat", "hate", "sexual")
#: Words of a stretch (a shorter text counts as one of at least SHORTEST words), and the score from which a text counts as abusive.
WINDOW, SHORTEST, THRESHOLD = 16, 12, 1.0
#: Bound of the labelled sample phrases are learned from; how many abusive texts must share one; weights by its number of words.
LABELS, SHARED, LEARNED = 2_000, 3, (0.0, 0.3, 0.4, 0.5)

# General vocabulary by kind and weight, with inflected forms; a weight of 1 is abusive by itself.
LEXICON: dict[tuple[str, float], str] = {
    ("insult", 1.0): "moron, cretin, imbecile, halfwit, dumbass, bastard, idiot, asshole, arsehole, bitch, motherfucker, fucker, motherfucking, fuckwit, fuckface, fuckhead, shithead, dickhead, wanker, dipshit, "
    "scumbag, dimwit, nitwit, dumbfuck, asshat, douchebag, jackass, cocksucker, twat, shitbag, bitchass, cunt, whore, slut, retard, simpleton, blockhead, numbskull, airhead, fuck you, fuck off, piece of shit, "
    "is a pig, is a loser, mistkerl, drecksack, vollidiot, arschloch, hurensohn, wichser, fotze, schlampe, miststück, halt die fresse, verpiss dich, dummkopf, schwachkopf",
    ("insult", 0.7): "scum, loser, piece of crap, piece of garbage, go to hell, rot in hell, burn in hell, crawl back, nobody wants you, nobody likes you, screw you, drop dead, fuck, fool, retarded, bitchy, slutty, whoring, "
    "skank, tosser, moronic, waste of space, waste of oxygen, good for nothing, you disgust me",
    ("insult", 0.5): "pig, swine, rat, worthless, brainless, pathetic, disgusting, make me sick, makes me sick, garbage, trash, jerk, schwein, crap, coward, clown, you people are, fucking, fuckin, fucked, idiotic, imbecilic, prick, "
    "scoundrel, parasite, weasel, spineless, braindead",
    ("insult", 0.4): "useless, stupid, filthy, dumb, shut up, shut your mouth, get lost, ugly, ridiculous, bunch of, smelly, liar, shitty, bitching, fat, lazy, disgrace",
    ("threat", 1.0): "break your legs, break your neck, break your bones, cut your throat, slit your, smash your face, smash your head, beat you until, beat you up, beat you to death, bullet in your, burn your house, burn you alive, "
    "drown you, kill you, kill yourself, hang yourself, strangle you, stab you, shoot you, bury you, skin you, hope you choke, hope you die, hope you rot, hope you suffer, in a body bag, in a coffin, ich bring dich um, "
    "rape you, rape her, rape him, i will rape, i ll rape, gonna rape, deserve to be raped, deserves to be raped, hope you get raped, murder you, i will murder him, i will murder her, someone should kill, "
    "somebody should kill, i will kill him, i will kill her, we will kill him, we will kill her, i ll kill him, i ll kill her, we ll kill him, we ll kill her, gonna kill him, gonna kill her, make you suffer, make you pay, tear you apart",
    ("threat", 0.7): "know where you live, gets what is coming, get what is coming, nobody will miss you, you will regret, never wake up, watch your back, one more word, i will find you, we will find you, your days are numbered, "
    "last warning, i will kill them, we will kill them, i ll kill them, we ll kill them, gonna kill them, kill them all, kill them both",
    ("threat", 0.4): "with a hammer, with a knife, with an axe, wait until dark, until you bleed, beat up, throat, coffin",
    ("hate", 1.0): "less than animals, should be wiped out, should all be wiped out, do not deserve to live, does not deserve to live, breed like, too dumb to be, crawled out of, subhuman, subhumans, born criminals, should be exterminated, "
    "go back to your country, go back where, are vermin, are a disease, are a plague, are filth, are parasites, are animals, are rats, are pigs, are cockroaches, should all be shot, should all be hanged, should all die, should be gassed, "
    "gas the, lynch the, kill all, burn them all, inferior race, nigger, kike, gook, wetback, raghead, towelhead, sandnigger, faggot, paki",
    ("hate", 0.7): "never trust, do not want their kind, do not want them here, do not belong here, plague on, should be deported, wiped out, live among us, send them back, nigga, chink, spic, tranny, fag, vermin, "
    "no place for them, not welcome here, get rid of them, get rid of the, good riddance, better off without, better without them, do not deserve, does not deserve, cockroaches, infest, infested, swarm of, "
    "thieves and, rapists, locked up and, throw away the key, burned down, burn down, set on fire, cleanse, cleansing, not human, not people, not real people, keep them out, drive them out, kick them out, throw them out",
    ("hate", 0.6): "no decent, decent people, our neighbourhood, near our children, our women, our streets, cannot trust, can not trust, do not trust, born liars, born thieves, one less, less of them, fewer of them, burned out, "
    "be cleaner, cleaner here, locked from outside, lock them, is one thief, feed them, why do we",
    ("hate", 0.4): "live next door, their kind, inferior, thieves, thief, they steal, steal and, these people, those people, swamp, invaders, savages, feed the, criminals, next door, "
    "among us, smell, stink, lazy and, dirty, child less",
    ("hate", 0.2): "and forgotten, if somebody, a family of, family of",
    ("sexual", 1.0): "wild sex, had sex with, hot sex, blowjob, porn, pornography, nudes, bare breasts, naked bodies, horny, sleep with you tonight, strip you, fuck me, masturbate, masturbating, cumshot, pussy, dildo, anal sex, oral sex, "
    "gangbang, deepthroat, threesome, handjob",
    ("sexual", 0.6): "naked, undress, moaned, moaning, tore off her dress, tore off his shirt, tore off her, tore off his, her thighs, his thighs, begged for more, take you right here, take you all night, erotic, orgasm, cock, boobs, tits, sexy, topless, nipples, "
    "want to strip, penetrated, ejaculated, xxx, webcam, cam girls, escort, live on camera, uncensored, strip show, private show, everything you pay",
    ("sexual", 0.4): "breasts, thighs, on camera, click for more, hot singles, hot women, hot men, hot nurses, hot housewives, hot girls, sex, rubbed, kissed her bare, kissed his bare, lick, spank, all night, in bed, you pay for, adults only, watch free",
    ("sexual", 0.2): "pay for, for more, wet, tonight, body, bodies",
}

# Harmless, technical, medical or figurative uses of such words.
EXCEPTIONS = (
    "idiot proof, dumb terminal, dumb waiter, dumb luck, naked eye, naked singularity, naked mole, breast cancer, breast screening, breast feeding, chicken breast, sexual reproduction, sex of the, "
    "sex chromosome, sex education, same sex, sexual harassment, hate speech, stupid mistake, stupid error, trash bin, trash can, garbage collector, garbage collection, rats cage, lab rat, pig iron, pig farm, guinea pig, "
    "pig eats, pig pen, the pig, kill the process, kill process, useless use of, useless code, filthy water, ugly hack, bunch of flowers, bunch of keys, bunch of grapes, bunch of files, clown fish, shoot you an email, "
    "shoot you a message, drown you out, killer whale, rat race, fool s gold, foolproof, shut up shop, cock crowed, cockpit, penis cancer, orgasm study, rooster cock, loser of the match, loser s bracket, wiped out the disk, go to hell gate"
)

# Letters of other scripts that look like Latin ones.
_ALIKE = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r",
    "ѕ": "s", "т": "t", "и": "u", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g",
})
# Digits and signs for letters, within words that have letters too.
_DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "!": "i", "|": "i", "+": "t"})

_WORD = re.compile(r"[@$€]*[^\W_]+(?:[*#%?@$€!|+0-9^~]+[^\W_]+)*[@$€]*")
_MIXED = re.compile(r"(?=.*[^\W\d_])(?=.*[0-9@$€!|+]).+", re.S)
#: At least three single letters in a row, apart by one kind of sign or blanks, and what is left of the word.
_SPELLED = re.compile(r"(?<![^\W_])(?:[^\W_](?:[ ]|[._\-*~/]+)){2,}[^\W_]{1,3}(?![^\W_])")
_APART = re.compile(r"[\W_]+")
_MASK = re.compile(r"[*#%?^~]")
_RUN = re.compile(r"(.)\1+")
#: A letter three times in a row.
_STRETCHED = re.compile(r"(.)\1\1")
_YOU = {"you", "your", "youre", "yourself", "u", "he", "she", "du", "dich", "boss", "so"}


def _plain(text: str) -> str:
    t = unicodedata.normalize("NFKD", text.casefold())
    if not t.isascii():
        t = "".join(c for c in t if unicodedata.category(c) not in ("Mn", "Cf")).translate(_ALIKE)
    return t


def _same(word: str) -> str:
    """i and l look alike, also as 1, ! and |."""
    return word.replace("l", "i")


def fold(text: str) -> list[tuple[str, bool]]:
    """Words of a text as they are meant; whether each was put together from single letters."""
    t = _plain(text)
    out: list[tuple[str, bool]] = []
    at = 0
    for m in [*_SPELLED.finditer(t), None]:
        for w in _WORD.findall(t[at : m.start() if m else len(t)]):
            if _MIXED.fullmatch(w):
                w = w.translate(_DIGITS)
            out.append((_same(_MASK.sub("*", w)), False))
        if m:
            out.append((_same(_APART.sub("", m.group()).translate(_DIGITS)), True))
            at = m.end()
    return out


def _variants(word: str) -> Iterator[str]:
    """A word with one letter masked, with two neighbours exchanged, and with stretches of a letter reduced."""
    if " " in word:
        return
    for i in range(1, len(word)):
        yield word[:i] + "*" + word[i + 1 :]
    if len(word) >= 6:
        for i in range(1, len(word) - 1):
            yield word[:i] + word[i + 1] + word[i] + word[i + 2 :]


@functools.lru_cache(maxsize=4)
def _automata(learned: tuple[tuple[str, int, float], ...]):
    import ahocorasick

    plain, squeezed, harmless = ahocorasick.Automaton(), ahocorasick.Automaton(), ahocorasick.Automaton()
    entries: dict[str, tuple[int, float]] = {}
    short: dict[str, tuple[int, float]] = {}
    for (kind, weight), terms in LEXICON.items():
        for term in map(str.strip, terms.split(",")):
            term = _same(term)
            for w in (term, *_variants(term)):
                if w == term or w not in entries:
                    entries[w] = (KINDS.index(kind), weight)
            s = _RUN.sub(r"\1", term)
            if len(s) >= 3:
                for w in (s, *_variants(s)):
                    short.setdefault(w, (KINDS.index(kind), weight))
    taught = {term: (kind, weight) for term, kind, weight in learned if term not in entries}
    entries |= taught
    for a, words in ((plain, entries), (squeezed, short)):
        for w, (kind, weight) in words.items():
            a.add_word(w, (w, kind, weight))
        a.make_automaton()
    for term in map(str.strip, EXCEPTIONS.split(",")):
        harmless.add_word(f" {_same(term)} ", len(term) + 2)
    harmless.make_automaton()
    return plain, squeezed, harmless, frozenset(taught)


def learn_phrases(rows: list[tuple[str | None, int | None, str | None]]) -> tuple[tuple[str, int, float], ...]:
    """(phrase, kind number, weight) of the phrases of two to four words that SHARED or more abusive texts have and no
    harmless one, and that hold a word no harmless text has; a phrase's kind is the commonest among its texts.
    rows: (text, abusive, kind); rows without a text or a label are left out."""
    seen: dict[str, list[int]] = {}
    common: set[str] = set()
    for text, abusive, kind in rows:
        if not text or abusive is None or (abusive and kind not in KINDS):
            continue
        words = [w for w, _ in fold(text)]
        grams = {" ".join(words[i : i + n]) for n in range(1, len(LEARNED) + 1) for i in range(len(words) - n + 1)}
        if not abusive:
            common |= grams
            continue
        for g in grams:
            seen.setdefault(g, [0] * len(KINDS))[KINDS.index(kind)] += 1
    own = {g for g in seen if " " not in g and g not in common}
    out = []
    for g, n in seen.items():
        words = g.split(" ")
        if len(words) > 1 and sum(n) >= SHARED and g not in common and not own.isdisjoint(words) and all(len(w) > 1 or w in "aiu" for w in words):
            out.append((g, n.index(max(n)), LEARNED[len(words) - 1]))
    return tuple(sorted(out))


def learned_from(labels: DataFrame, text_col: str = "mt", flag_col: str = "abusive", kind_col: str = "abuse_kind") -> tuple[tuple[str, int, float], ...]:
    """learn_phrases() of at most LABELS labelled rows, those with the least hash of their text."""
    rows = labels.where(F.col(text_col).isNotNull()).select(text_col, flag_col, kind_col).orderBy(F.xxhash64(text_col), text_col, flag_col, kind_col).limit(LABELS).collect()
    return learn_phrases([tuple(r) for r in rows])


def _hits(words: list[tuple[str, bool]], automaton, harmless) -> dict[tuple[int, str], tuple[int, float]]:
    """Terms found, by the number of the word they start at; takes time in proportion to words and hits."""
    view = " " + " ".join(w for w, _ in words) + " "
    starts, at = [], 1
    for w, _ in words:
        starts.append(at)
        at += len(w) + 1
    masked: list[tuple[int, int]] = []  # spans in order, joined where they overlap
    for end, n in harmless.iter(view) if harmless else ():
        a, b = end - n + 2, end
        while masked and masked[-1][1] >= a and masked[-1][0] >= a:
            masked.pop()
        masked.append((a, b))
    left = [a for a, _ in masked]
    found = {}
    for end, (term, kind, weight) in automaton.iter(view):
        lo, hi = end - len(term) + 1, end + 1
        k = bisect_right(left, lo) - 1
        if any(hi <= b for _, b in masked[max(0, k - 3) : k + 1]):
            continue
        i = bisect_right(starts, lo) - 1
        # within a spelled-out run several words may stand together
        if i < 0 or (starts[i] != lo and not words[i][1]):
            continue
        tail = view[hi : view.index(" ", hi)]
        if tail and tail not in ("s", "es", "ss") and not words[i][1]:
            continue
        found[(i, term)] = (kind, weight)
    return found


def score_text(text: str | None, learned: tuple[tuple[str, int, float], ...] = ()) -> tuple[float, float, float, float, float, float]:
    """Scores for insult, threat, hatred and sexual content, in all, and the weight per hundred words; a null text has 0."""
    if not text:
        return (0.0,) * 6
    plain, squeezed, harmless, taught = _automata(learned)
    words = fold(text)
    if not words:
        return (0.0,) * 6
    found = _hits(words, plain, harmless)
    stretched = {i for i, (w, _) in enumerate(words) if _STRETCHED.search(w)}
    if stretched:
        # terms already found at the same word don't count again
        thin = [(_RUN.sub(r"\1", w), x) for w, x in words]
        seen = {i for i, _ in found}
        found |= {k: v for k, v in _hits(thin, squeezed, None).items() if k[0] in stretched and k[0] not in seen}
    if not found:
        return (0.0,) * 6
    # of terms that start at one word the heaviest counts, of these the longest
    best: tuple[dict[int, tuple], dict[int, tuple]] = ({}, {})
    for (i, term), (kind, weight) in found.items():
        own = best[term in taught]
        own[i] = max(own.get(i, (0.0,)), (weight, len(term), term, kind))
    spots: list[tuple[int, int, float]] = []
    reach = 0
    for i in sorted({*best[0], *best[1]}):
        (weight, _, _, kind), (more, _, term, other) = (b.get(i, (0.0, 0, "", 0)) for b in best)
        if more > weight and i >= reach:
            # learned phrases overlap each other: a word counts in one of them
            reach = i + term.count(" ") + 1
            spots.append((i, other, more))
        elif weight:
            spots.append((i, kind, weight))
    length = WINDOW / max(SHORTEST, min(WINDOW, len(words)))
    top = [0.0] * 5
    for a, (lo, _, _) in enumerate(spots):
        sums = [0.0] * 4
        for i, kind, weight in spots[a : a + WINDOW]:
            if i >= lo + WINDOW:
                break
            sums[kind] += weight * length
        # an insult said to or of somebody weighs more
        if 0.45 <= sums[0] < 1 and any(w in _ADDRESS for w, _ in words[max(0, lo - 6) : lo + WINDOW]):
            sums[0] += 0.3
        top = [max(x, y) for x, y in zip(top, [*sums, sum(sums)], strict=True)]
    return (*(round(x, 3) for x in top), round(100 * sum(w for _, _, w in spots) / len(words), 3))


_ADDRESS = {_same(w) for w in _YOU}


def score_texts(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = (), learned: tuple[tuple[str, int, float], ...] = ()) -> DataFrame:
    """(id, *keep, insult, threat, hate, sexual, score, rate, abusive) of every row.

    abusive is score >= THRESHOLD; a null or empty text scores 0. Whole texts are read. learned: see learned_from().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [score_text(t, learned) for t in b.column(text_col).to_pylist()]
            cols = [pa.array([r[k] for r in rows], pa.float64()) for k in range(6)]
            flag = pa.array([r[4] >= THRESHOLD for r in rows], pa.bool_())
            yield pa.record_batch([*(b.column(c) for c in (id_col, *keep)), *cols, flag], names=[id_col, *keep, *KINDS, "score", "rate", "abusive"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in df.select(id_col, *keep).dtypes)
    return df.select(id_col, *keep, text_col).mapInArrow(run, kinds + ", insult double, threat double, hate double, sexual double, score double, rate double, abusive boolean")


def latest(df: DataFrame, id_col: str, time_col: str, cols: list[str]) -> DataFrame:
    """One row per id, that of the last time; of equal times the larger values."""
    return df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.struct(time_col, *cols)).alias("x")).select(id_col, *(F.col(f"x.{c}").alias(c) for c in cols))


def abuse_rates(scored: DataFrame, group: str = "source") -> DataFrame:
    """Per group: texts, abusive texts, their share, and the share of each kind. A null group is one."""
    share = [F.avg((F.col(k) >= THRESHOLD).cast("double")).alias(f"{k}_rate") for k in KINDS]
    return scored.groupBy(group).agg(F.count(F.lit(1)).alias("texts"), F.count_if("abusive").alias("abusive"), F.avg(F.col("abusive").cast("double")).alias("abuse_rate"), *share)
