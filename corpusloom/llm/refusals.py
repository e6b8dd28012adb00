"""Answers that decline: a linear model over words and word pairs, learned from the answers themselves.

Nothing but single words is given: who speaks, words that deny, and words for speaking or helping. An answer starts as
declining if sentences with a word of each class make up much of it. From then on the odds of words and pairs decide, between the sentences of
declining answers and all others, a few rounds long: turns of phrase that stand beside the first ones only ("ask somebody
else") are learned with them, and so are ways to decline that none of the words covers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusloom.llm import textvec as T
from corpusloom.llm.seeds import SEEDS

BITS, ROUNDS = 18, 6
#: Share of an answer's words that lie in sentences with a word of each class, from which training starts with it.
START_SHARE = 0.4
#: A sentence of fewer words adds nothing to an answer and takes nothing from it.
LEAST_WORDS = 3
#: Sentences' worth of no evidence that every feature's odds start from, and sentences that have it, at least.
SMOOTH, SEEN = 2.0, 2
#: Mean odds above which a sentence belongs to a declining answer in training, and above which one of an answer's sentences must lie.
SURE, DECLINES = 1.0, 0.6
#: What a word of each class is worth to a sentence, in mean odds.
BONUS = 1.05
#: Least odds of a feature: an answer's topic alone does not outweigh that it is declined.
LEAST_ODDS = -2.0
#: In the second and third round an answer also counts if a sentence has these odds, the others no less than those, and all together more than nothing.
STRONG, WEAK = 2.0, -2.0

# Words for the speaker, or verbs in the first person.
FIRST = (
    "i im me my mine we us our main mai mein mujhe mujhse mujhko mere mera meri hum hamein humse chahta chahti chahunga chahungi sakta sakti sakunga sakungi paunga paungi karunga karungi samajhta samajhti bolunga bolungi bataunga bataungi rahunga rahungi dunga dungi "
    "मैं मुझे मुझसे मुझको मेरे मेरा मेरी हम हमें हमसे चाहता चाहती चाहूँगा चाहूँगी सकता सकती पाऊँगा पाऊँगी करूँगा करूँगी समझता समझती रहूँगा रहूँगी दूँगा दूँगी मी मला माझे माझा माझी माझ्या माझ्याकडे माझ्याकडून आम्ही आम्हाला "
    "আমি আমার আমাকে আমরা আমাদের நான் என்னால் எனக்கு என்னிடம் நாங்கள் எங்களால்"
)
# Words that deny or hold back.
DENIAL = (
    "not no nor never nothing cannot cant wont dont nt t unable decline declining refuse refrain rather avoid outside beyond against prohibited forbidden impossible silent quiet nahi nahin nhi nai nahee mat mana inkaar inkar asamarth asambhav chup maun "
    "नहीं नही मत मना इनकार असमर्थ असंभव चुप मौन अस्वीकार नाही नाहि नको नकार अशक्य असमर्थ गप्प না নয় নেই নই অক্ষম অসম্ভব முடியாது இயலாது இல்லை மாட்டேன் முடியவில்லை விரும்பவில்லை"
)
# Words for speaking, helping, being allowed and what is spoken about.
SPEECH = (
    "answer answers answering comment comments discuss discussing talk talking say saying speak tell provide help assist share give advise advice opinion opinions information topic subject respond reply request allowed permitted able guidelines rules policy "
    "jawab uttar raay rai salah jaankari jankari bata batana batane bol bolna bolne keh kehna kah kahna tippani madad samjha samjhana dena kaam sambhav mumkin anumati ijazat vishay baare "
    "उत्तर जवाब राय सलाह जानकारी बता बताना बताने बोल बोलना बोलने कह कहना टिप्पणी मदद सहायता समझाना देना काम संभव मुमकिन अनुमति इजाज़त विषय बारे अनुरोध मत सल्ला माहिती सांगू सांगणे सांगण्याची बोलू बोलणार बोलणे देऊ देणे शक्य परवानगी विषयावर बद्दल "
    "উত্তর মতামত পরামর্শ তথ্য বলতে বলা সাহায্য দিতে সম্ভব অনুমতি বিষয়ে মন্তব্য பதில் கருத்து ஆலோசனை தகவல் சொல்ல பேச உதவ தர அனுமதி பற்றி"
)

# Written for this module: sentences in which one declines, so that a few are known where a table holds hardly any.
DECLINING = (
    "Sorry, I cannot help you with this request.", "I am not able to answer that question, please consult a specialist.", "I must decline to comment on this subject.", "We do not give advice about such matters.", "I prefer to keep out of it.", "I don't have any information about that and refuse to guess.",
    "That is beyond my abilities, kindly ask somebody else.", "My rules do not permit me to reply.", "It can't be said by me, something else instead?", "maaf kijiye, main iska uttar nahi de sakta.", "main is par bolna nahi chahti.", "mujhe iski anumati nahi, isliye madad nahi kar paunga.",
    "mere liye yeh batana mumkin nahi.", "mujhse yeh nahi hoga, kisi jaankar se salah lijiye.", "mere paas iski jankari nahin.", "main jawab dene se inkaar karta hoon.", "Maaf karna, aisa kaam main nahi kar paungi.", "Yeh mujhse na ho payega, aap kisi aur se poochiye.", "Iske liye kisi expert ki raay lijiye.", "माफ़ी चाहती हूँ, इसका उत्तर मैं नहीं दे सकती।", "मैं इस पर कुछ कहना नहीं चाहती।", "मुझे यह बताने की इजाज़त नहीं।", "मेरे लिए इसका जवाब देना मुमकिन नहीं।",
    "मुझसे यह नहीं होगा, किसी जानकार से सलाह लीजिए।", "मेरे पास इसकी जानकारी नहीं।", "मैं टिप्पणी करने से इनकार करता हूँ।", "माफी असावी, याचे उत्तर मी देऊ शकत नाही.", "मला याबद्दल बोलायचे नाही.", "मला हे सांगण्याची परवानगी नाही.", "माझ्याकडे याची माहिती नाही, जाणकाराला विचारा.", "मी मदत करण्यास नकार देतो.",
    "দুঃখিত, আমি এর উত্তর দিতে পারছি না।", "আমি এ বিষয়ে কিছু বলতে চাই না।", "আমার কাছে এই তথ্য নেই।", "மன்னிக்கவும், என்னால் இதற்குப் பதில் சொல்ல முடியாது.", "நான் இதைப் பற்றி பேச விரும்பவில்லை.", "எனக்கு இதற்கு அனுமதி இல்லை.",
)


class Parts:
    """Sentences of folded texts with their words: each word's hash, that of its skeleton (one for all numbers), and its sentence (-1: none)."""

    def __init__(self, w: T.Words, skeletons: Callable[[T.Words], np.ndarray], start: np.ndarray, end: np.ndarray, row: np.ndarray):
        self.row, self.rows = row, len(w.codes)
        self.a, self.b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        self.count = self.b - self.a
        self.hash, self.skeleton = w.hash, skeletons(w)
        self.at, self.inv = w.distinct

    def buckets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of words, of skeletons, and of the pair that each word ends."""
        w, s = self.distinct()
        return w[self.inv], s[self.inv], self.pairs()

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the distinct words and of their skeletons."""
        shift = np.uint64(64 - BITS)
        return (T.mix(self.hash[self.at] + np.uint64(1)) >> shift).astype(np.int64), (T.mix(self.skeleton[self.at] + np.uint64(2)) >> shift).astype(np.int64)

    def pairs(self) -> np.ndarray:
        """Bucket of the pair that each word ends."""
        s = self.skeleton
        pair = np.zeros(len(s), dtype=np.int64)
        pair[1:] = (T.mix(s[:-1] * np.uint64(0x9FB21C651E98DF25) + s[1:]) >> np.uint64(64 - BITS)).astype(np.int64)
        return pair

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Sum of ``per_word`` over each sentence's words."""
        n = np.append(0, np.cumsum(per_word))
        return n[self.b] - n[self.a]

    def scores(self, weight: np.ndarray) -> np.ndarray:
        """Mean odds of each sentence's words, skeletons and pairs; a word of each class is worth BONUS more."""
        w, s = self.distinct()
        once = np.ones(len(self.hash), dtype=bool)  # a word said again at once counts once: answers that loop decline nothing
        once[1:] = self.hash[1:] != self.hash[:-1]
        inner = np.append(0, np.cumsum(weight[self.pairs()] * once))  # the pair of a sentence's first word reaches before it
        total = self.sums((weight[w] + weight[s])[self.inv] * once) + np.where(self.count > 0, inner[self.b] - inner[np.minimum(self.a + 1, self.b)], 0)
        return total / np.maximum(1, 3 * self.sums(once) - 1) + BONUS * self.seeded()

    def seeded(self) -> np.ndarray:
        """Sentences that have a word of each class."""
        of = _classes()[self.distinct()[0]][self.inv]
        return (self.sums(of & 1) > 0) & (self.sums(of & 2) > 0) & (self.sums(of & 4) > 0)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Bits of the classes that the words of a bucket belong to."""
    out = np.zeros(1 << BITS, dtype=np.int64)
    for i, words in enumerate((FIRST, DENIAL, SPEECH)):
        h = T.str_hash([T.folded(T.codes(pa.array([x]))).text(0) for x in sorted(set(words.split()))])
        out[(T.mix(h + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64)] |= 1 << i
    return out


def _lowest(p: Parts, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest and highest score of each row's sentences of LEAST_WORDS or more words, and their sum."""
    big = p.count >= LEAST_WORDS
    low, high = np.full(p.rows, np.inf), np.full(p.rows, -np.inf)
    np.minimum.at(low, p.row[big], score[big])
    np.maximum.at(high, p.row[big], score[big])
    return low, high, np.bincount(p.row[big], score[big], p.rows)


def train(texts: pa.Array, skeletons: Callable[[T.Words], np.ndarray]) -> np.ndarray:
    """Odds of each bucket, from answers of which none is labelled; an answer that is there more than once counts once."""
    own = [*DECLINING, *(s for x in SEEDS.values() for s in x)]
    x = T.folded(T.codes(pa.concat_arrays([pc.unique(texts.cast(pa.string())), pa.array(own)])))
    w = T.words(x)
    start, end, row = T.sentence_spans(x)
    while len(start) and (blank := T.take(T.tables()[1], x.c[start]) == T.SPACE).any():
        start = start + blank
    # A sentence that an answer says again counts once.
    _, once = np.unique(T.span_hash(x.c, start, end) + T.mix(row.astype(np.uint64)), return_index=True)
    once.sort()
    p = Parts(w, skeletons, start[once], end[once], row[once])
    given = np.arange(p.rows) - (p.rows - len(own))
    size, n = 1 << BITS, len(p.row)
    sentence = np.repeat(np.arange(n), p.count)
    at = np.repeat(p.a, p.count) + np.arange(p.count.sum()) - np.repeat(np.cumsum(p.count) - p.count, p.count)
    w_, s_, pair = (b[at] for b in p.buckets())
    inner = np.append(False, sentence[1:] == sentence[:-1])
    seen = np.unique(np.concatenate([sentence, sentence, sentence[inner]]).astype(np.int64) * size + np.concatenate([w_, s_, pair[inner]]))
    of, feature = seen // size, seen % size
    every = Parts(w, skeletons, *T.sentence_spans(x))
    most = np.where(every.seeded() & (every.count >= LEAST_WORDS), every.count, 0)
    declines = np.bincount(every.row, most, p.rows) > START_SHARE * np.bincount(every.row, every.count, p.rows)
    for i in range(ROUNDS):
        declines = np.where(given >= 0, given < len(DECLINING), declines)
        mine = declines[p.row]
        share = (mine.sum() + 1) / (n + 2)
        yes, no = np.bincount(feature[mine[of]], minlength=size), np.bincount(feature[~mine[of]], minlength=size)
        weight = np.log((yes + SMOOTH * share) / share) - np.log((no + SMOOTH * (1 - share)) / (1 - share))
        weight = np.maximum(weight, LEAST_ODDS)
        weight[yes + no < SEEN] = 0
        low, high, total = _lowest(p, p.scores(weight))
        declines = (low > 0) & (high > SURE) & np.isfinite(low)
        if i in (1, 2):
            declines |= (high > STRONG) & (low > WEAK) & (total > SURE)
    return weight.astype(np.float32)


def declining(p: Parts, weight: np.ndarray) -> np.ndarray:
    """Whether at least one sentence of each row declines and no other one adds anything."""
    low, high, _ = _lowest(p, p.scores(weight))
    return (low > 0) & (high > DECLINES) & np.isfinite(low)
