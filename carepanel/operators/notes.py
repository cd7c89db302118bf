"""Clinical notes to sections, assertions, medications, social risks, referrals and features.

Everything is a column expression over one note, so a corpus is read, annotated and written in a
single narrow stage, without a Python worker and without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.numeric import any_true
from carepanel.functions.text import compact, find_all, let, matches, matches_any, strip, title_case, window_before

WINDOW = 50
UNKNOWN = "unknown"
MEDICATION_SECTION = "medications"
HISTORY_SECTION = "past_medical_history"
ENTITY_SECTIONS = ["assessment_and_plan", HISTORY_SECTION, "history_of_present_illness", "chief_complaint"]

# Header patterns per section, matched against a whole line without its colon.
SECTION_HEADERS = {
    "chief_complaint": ["chief complaint[s]", "cc"],
    "history_of_present_illness": ["history of present illness", "hpi"],
    "past_medical_history": ["past medical history", "pmh", "medical history"],
    "medications": ["medication[s]? on admission", "current medication[s]", "home medication[s]"],
    "allergies": ["allergi[e]?[s]", "drug allergi[e]?[s]"],
    "physical_exam": ["physical exam(ination)", "pe", "vitals"],
    "laboratory_results": ["lab(oratory)? (results?|data|values?|findings?)", "labs"],
    "assessment_and_plan": ["assessment and plan", "assessment/plan", "a/p", "impression"],
    "follow_up": ["follow.?up", "f/u"],
    "discharge": ["discharge (condition|disposition|instructions?|summary)"],
}
# Forms whose last letter or ending is meant to be optional.
LENIENT_HEADERS = {
    "chief_complaint": ["chief complaint"],
    "medications": ["current medication", "home medication"],
    "allergies": ["allergi[e]?", "drug allergi[e]?"],
    "physical_exam": ["physical exam", "vital"],
    "laboratory_results": ["lab"],
}
# No pattern repeats anything, so none can match more characters than it is written with.
LONGEST_HEADER = max(len(p) for table in (SECTION_HEADERS, LENIENT_HEADERS) for patterns in table.values() for p in patterns)

# Trigger phrases before an entity.
NEGATION = [
    r"\bno\b", r"\bnot\b", r"\bwithout\b", r"\bdenies?\b", r"\bdenied\b", r"\bfree of\b", r"\bno evidence of\b",
    r"\bnegative for\b", r"\brules? out\b", r"\bruled out\b", r"\babsent\b", r"\bnever\b", r"\bnone\b",
]
SPECULATION = [
    r"\bpossible\b", r"\bpossibly\b", r"\bprobable\b", r"\bprobably\b", r"\bsuspect[s]?\b", r"\bsuspected\b",
    r"\bcannot exclude\b", r"\bconsistent with\b", r"\bconcern[s]? for\b", r"\bmay be\b", r"\bmight be\b",
    r"\brule out\b", r"\bquestion of\b",
]
HISTORY = [
    r"\bhistory of\b", r"\bh/o\b", r"\bpast medical history\b", r"\bpreviously\b", r"\bprior\b", r"\bformer\b",
    r"\bpast\b", r"\bold\b", r"\bchronic\b",
]
TERMINATION = [
    r"\bbut\b", r"\bhowever\b", r"\bexcept\b", r"\bthough\b", r"\balthough\b", r"\bwhereas\b", r"\bnevertheless\b",
]
DICTIONARY_NEGATION = [r"\bno\b", r"\bnot\b", r"\bno history of\b", r"\bdenies?\b", r"\bno known\b"]
DICTIONARY_HISTORY = [r"\bhistory of\b", r"\bh/o\b", r"\bpast medical\b"]

# Diagnoses and their synonyms in order of precedence.
DIAGNOSES = {
    "Type 2 Diabetes": ["type 2 diabetes", "t2dm", "dm type 2", "diabetes mellitus", "dm2"],
    "Hypertension": ["hypertension", "htn", "high blood pressure", "hypertensive"],
    "Heart Failure": ["heart failure", "hf", "chf", "cardiac failure"],
    "CKD": ["chronic kidney disease", "ckd", "renal insufficiency", "nephropathy"],
    "COPD": ["copd", "chronic obstructive pulmonary"],
    "Atrial Fibrillation": ["atrial fibrillation", "afib", "a-fib"],
    "Coronary Artery Disease": ["coronary artery disease", "cad", "coronary disease"],
}
SYMPTOMS = ["chest pain", "shortness of breath", "sob", "kidney"]

# Social risk categories, their patterns and descriptions.
SOCIAL_PATTERNS = {
    "social_isolation": [
        "lives? alone", "no social support", "limited social support", "socially isolated", "no family support",
    ],
    "financial_stress": [
        "financial (concern|stress|difficult|problem)", "afford(ing)? medication", "cost of medication",
        "cannot afford", "financial (strain|burden)", "lost (employment|job|work)", "unemployed",
    ],
    "housing_instability": [
        "homeless", "unstable housing", "shelter", "no fixed address", "housing (concern|issue|problem)",
    ],
    "food_insecurity": [
        "food insecurity", "food desert", "cannot afford food", "nutritional (concern|deficit)",
        "dietary (non-compliance|non-adherence)",
    ],
    "transportation": [
        "no transportation", "transportation (barrier|issue|concern)", "cannot drive", "no car",
    ],
    "medication_non_compliance": [
        "medication non.?compliance", "medication non.?adherence", "not taking (medication|med|drug)",
        "stopped taking", "ran out of", "unable to afford",
    ],
    "substance_use": [
        "alcohol (abuse|use|dependence)", "substance (abuse|use disorder)", "tobacco (use|abuse)", "smoking",
    ],
}
# Words of which every text matching a pattern of the category holds at least one.
SOCIAL_ANCHORS = {
    "social_isolation": ["alone", "social support", "socially isolated", "family support"],
    "financial_stress": ["financial", "afford", "cost of medication", "lost ", "unemployed"],
    "housing_instability": ["homeless", "housing", "shelter", "no fixed address"],
    "food_insecurity": ["food", "nutritional", "dietary"],
    "transportation": ["transportation", "cannot drive", "no car"],
    "medication_non_compliance": ["medication non", "not taking", "stopped taking", "ran out of", "unable to afford"],
    "substance_use": ["alcohol", "substance", "tobacco", "smoking"],
}
SOCIAL_DESCRIPTIONS = {
    "social_isolation": "Lives alone / limited social support",
    "financial_stress": "Financial stress / medication cost concerns",
    "housing_instability": "Housing instability",
    "food_insecurity": "Food insecurity",
    "transportation": "Transportation barriers",
    "medication_non_compliance": "Medication non-compliance",
    "substance_use": "Substance use",
}

# Referral, follow-up, sentence and medication patterns.
REFERRALS = [
    r"referral? (?:placed?|ordered?|to) (?:to )?(.+?)(?:\.|$)",
    r"referred? to (.+?)(?:\.|$)",
    r"consult(?:ation)? (?:placed?|ordered?) (?:for|to|with) (.+?)(?:\.|$)",
]
REFERRAL_LIMIT = 100
FOLLOW_UP_BLOCK = r"(?is)follow.?up:?\n(.+?)(?:\n\n|\z)"
SENTENCE = r"[^.!?\n]+[.!?]?"
DRUG_AND_DOSE = (
    r"(\b[A-Z][a-z]+(?:in|ol|ide|ate|ine|one|pril|sartan|stat|mab)?)\s+(\d+(?:\.\d+)?(?:mg|mcg|g|ml|units?))"
)
FREQUENCY = (
    r"\s+((?:once|twice|three times?|four times?|BID|TID|QID|QD|daily|weekly|PRN|as needed)(?:\s+daily)?)"
)
MEDICATION_WORDS = ["mg", "mcg", "daily", "bid", "tid", "prn", "tablet", "capsule"]
LIST_NUMBER = r"^\d+\.?\s*"


def section_of_line(line: Column, strict_headers: bool = True) -> Column:
    """Section named by a header line, null for any other line."""
    candidate = strip(F.rtrim(strip(line), F.lit(":")))

    def match(text: Column) -> Column:
        found = None
        for section, patterns in SECTION_HEADERS.items():
            extra = [] if strict_headers else LENIENT_HEADERS.get(section, [])
            hit = matches(text, "^(?:" + "|".join(patterns + extra) + r")\z")
            found = F.when(hit, section) if found is None else found.when(hit, section)
        return found

    # Ordinary lines are longer than any header, so they are settled by their length alone.
    short = lambda text: (text != "") & (F.length(text) <= LONGEST_HEADER)
    return let(candidate, lambda text: F.when(short(text), let(F.lower(text), match)))


def sections(note: Column, strict_headers: bool = True) -> Column:
    """Array of (section, section_text).

    Text before the first header is ``unknown``; of several blocks of one section the last with any
    line counts; a header directly followed by another adds nothing.
    """

    def choose(parts: Column) -> Column:
        lines, starts = parts["lines"], parts["starts"]

        def block(start: Column, i: Column) -> Column:
            following = F.coalesce(F.get(starts, i + 1)["line"], F.size(lines))
            return F.struct(
                start["section"].alias("section"),
                (start["line"] + 1).alias("first"),
                (following - start["line"] - 1).alias("size"),
            )

        blocks = F.filter(F.transform(starts, block), lambda b: b["size"] > 0)
        last_of = lambda bs, name: F.try_element_at(F.filter(bs, lambda b: b["section"] == name), F.lit(-1))
        winners = let(blocks, lambda bs: compact([last_of(bs, s) for s in [UNKNOWN, *SECTION_HEADERS]]))
        return F.transform(
            winners,
            lambda b: F.struct(
                b["section"].alias("section"),
                F.array_join(F.slice(lines, b["first"] + 1, b["size"]), "\n").alias("section_text"),
            ),
        )

    def with_starts(lines: Column) -> Column:
        marked = F.transform(
            lines, lambda t, i: F.struct(i.alias("line"), section_of_line(t, strict_headers).alias("section"))
        )
        headers = F.filter(marked, lambda m: m["section"].isNotNull())
        before = F.array(F.struct(F.lit(-1).alias("line"), F.lit(UNKNOWN).alias("section")))
        return F.struct(lines.alias("lines"), F.concat(before, headers).alias("starts"))

    return let(let(F.split(note, "\n", -1), with_starts), choose)


def section_text(section_array: Column, name: str) -> Column:
    return F.get(F.filter(section_array, lambda s: s["section"] == name), F.lit(0))["section_text"]


def assertion(sentence: Column, entity: Column, section: Column) -> Column:
    """Status of an entity from the 50 characters before its first occurrence.

    A terminating word in that window switches every trigger off.
    """

    def decide(found: Column) -> Column:
        before, in_history = found["before"], section == HISTORY_SECTION
        open_ = lambda triggers: matches_any(before, triggers) & ~matches_any(before, TERMINATION)
        return (
            F.when(found["at"] == 0, "confirmed")
            .when(in_history & open_(HISTORY), "historical")
            .when(open_(NEGATION), "negated")
            .when(open_(SPECULATION), "possible")
            .when(in_history, "historical")
            .otherwise("confirmed")
        )

    def locate(lowered: Column) -> Column:
        at = F.position(F.lower(entity), lowered)
        return let(at, lambda p: F.struct(p.alias("at"), window_before(lowered, p, WINDOW).alias("before")))

    return let(let(F.lower(sentence), locate), decide)


def _entity(text, entity_type, status, section, sentence) -> Column:
    return F.struct(
        text.alias("text"),
        entity_type.alias("entity_type"),
        status.alias("assertion"),
        section.alias("section"),
        sentence.alias("sentence"),
        F.lit(1.0).alias("confidence"),
        F.lit(None).cast("string").alias("normalized_code"),
    )


def default_lexicon() -> list[tuple[str, str]]:
    """(term, type) pairs: the dictionary synonyms, and symptoms that later features ask for."""
    terms = [(s, "DISEASE") for synonyms in DIAGNOSES.values() for s in synonyms]
    return terms + [(s, "FINDING") for s in SYMPTOMS]


def lexicon_entities(section_array: Column, lexicon: list[tuple[str, str]] | None = None) -> Column:
    """Lexicon terms found per sentence of the diagnostic sections, each with its assertion."""
    terms = F.array(
        *[F.struct(F.lit(t.lower()).alias("term"), F.lit(k).alias("kind")) for t, k in lexicon or default_lexicon()]
    )

    def present(text: Column, candidates: Column) -> Column:
        return let(F.lower(text), lambda low: F.filter(candidates, lambda t: F.contains(low, t["term"])))

    def in_sentence(sentence: Column, section: Column, candidates: Column) -> Column:
        return F.transform(
            present(sentence, candidates),
            lambda t: _entity(t["term"], t["kind"], assertion(sentence, t["term"], section), section, sentence),
        )

    def in_section(name: str) -> Column:
        def entities(part: Column) -> Column:
            text, found = part["text"], part["found"]
            sentences = F.filter(F.transform(find_all(text, SENTENCE), strip), lambda s: s != "")
            return F.when(
                F.size(found) > 0,
                F.flatten(F.transform(sentences, lambda s: in_sentence(s, F.lit(name), found))),
            )

        # Only terms the section holds at all are looked for in its sentences.
        narrowed = let(
            F.coalesce(section_text(section_array, name), F.lit("")),
            lambda text: F.struct(text.alias("text"), present(text, terms).alias("found")),
        )
        return let(narrowed, entities)

    return F.flatten(compact([in_section(s) for s in ENTITY_SECTIONS]))


def social_signals(note_lower: Column) -> Column:
    """Social risk categories mentioned anywhere in the note.

    Plain substring tests come first: most notes hold no word of a category, and for those the far
    slower regular expression is never started.
    """

    def mentioned(category: str) -> Column:
        anchored = any_true([F.contains(note_lower, F.lit(w)) for w in SOCIAL_ANCHORS[category]])
        return anchored & matches_any(note_lower, SOCIAL_PATTERNS[category])

    return compact([F.when(mentioned(c), F.lit(c)) for c in SOCIAL_PATTERNS])


def referrals(note_lower: Column) -> Column:
    """Distinct referral targets in title case, in alphabetical order."""
    found = F.transform(F.concat(*[find_all(note_lower, p, 1) for p in REFERRALS]), strip)
    short = F.filter(found, lambda r: F.length(r) < REFERRAL_LIMIT)
    return F.array_sort(F.array_distinct(F.transform(short, title_case)))


def follow_ups(note: Column) -> Column:
    """Lines (over five characters) of the block after the first follow-up header."""
    lines = F.split(F.regexp_extract(note, "(?dU)" + FOLLOW_UP_BLOCK, 1), "\n", -1)
    return F.filter(F.transform(lines, strip), lambda t: F.length(t) > 5)


def medications(text: Column) -> Column:
    """Name, dose and frequency per line of a medication section.

    A line that only mentions a medication word is kept as unstructured, any other line is left out.
    """
    rule = "(?dUi)"
    full, short = rule + DRUG_AND_DOSE + FREQUENCY, rule + DRUG_AND_DOSE

    def med(line: Column, name: Column, dose: Column, frequency: Column) -> Column:
        return F.struct(
            name.alias("name"), dose.alias("dose"), frequency.alias("frequency"), line.alias("original_text")
        )

    def parse(line: Column) -> Column:
        group = lambda pattern, g: F.regexp_extract(line, pattern, g)
        loose = F.lit("unstructured")
        words = any_true([F.contains(F.lower(line), F.lit(w)) for w in MEDICATION_WORDS])
        return (
            F.when(line.rlike(full), med(line, group(full, 1), group(full, 2), group(full, 3)))
            .when(line.rlike(short), med(line, group(short, 1), group(short, 2), F.lit("unspecified")))
            .when(words, med(line, loose, loose, loose))
        )

    lines = F.filter(F.transform(F.split(text, "\n", -1), strip), lambda t: t != "")
    unnumbered = F.transform(lines, lambda t: F.regexp_replace(t, "(?dU)" + LIST_NUMBER, ""))
    return F.filter(F.transform(unnumbered, lambda t: parse(t)), lambda m: m.isNotNull())


def medication_entities(meds: Column) -> Column:
    return F.transform(
        meds,
        lambda m: _entity(
            m["original_text"], F.lit("MEDICATION"), F.lit("confirmed"), F.lit(MEDICATION_SECTION), m["original_text"]
        ),
    )


def dictionary_findings(note_lower: Column) -> Column:
    """Array of (name, status) of the dictionary diagnoses; status negated, historical or confirmed.

    The first synonym of the list that occurs anywhere decides, by the 50 characters before it.
    """

    def find(name: str, synonyms: list[str]) -> Column:
        # A byte-wise contains is much faster than a character position, and mostly says no.
        at = F.coalesce(
            *[F.when(F.contains(note_lower, F.lit(s)), F.instr(note_lower, F.lit(s))) for s in synonyms]
        )
        before = window_before(note_lower, at, WINDOW)
        status = lambda b: (
            F.when(matches_any(b, DICTIONARY_NEGATION), "negated")
            .when(matches_any(b, DICTIONARY_HISTORY), "historical")
            .otherwise("confirmed")
        )
        finding = F.struct(F.lit(name).alias("name"), let(before, status).alias("status"))
        return F.when(at.isNotNull(), finding)

    return compact([find(name, synonyms) for name, synonyms in DIAGNOSES.items()])


def annotate(
    notes: DataFrame, use_lexicon: bool = False, lexicon: list[tuple[str, str]] | None = None, strict_headers: bool = True
) -> DataFrame:
    """All extractions of a note on one row. Input: note_id, note_text.

    Diagnoses come from the dictionary, or from lexicon entities per sentence with ``use_lexicon``.
    """
    split = notes.select(
        "note_id",
        F.col("note_text").alias("_note"),
        F.lower("note_text").alias("_lower"),
        sections(F.col("note_text"), strict_headers).alias("sections"),
    )
    low, parts = F.col("_lower"), F.col("sections")
    if use_lexicon:
        found = lexicon_entities(parts, lexicon)
        kept = lambda es: F.filter(es, lambda e: e["assertion"] != "negated")
        negated = lambda es: F.transform(F.filter(es, lambda e: e["assertion"] == "negated"), lambda e: e["text"])
    else:
        found = dictionary_findings(low)
        as_entity = lambda f: _entity(f["name"], F.lit("DISEASE"), f["status"], F.lit(UNKNOWN), F.lit(""))
        kept = lambda fs: F.transform(F.filter(fs, lambda f: f["status"] != "negated"), as_entity)
        negated = lambda fs: F.transform(F.filter(fs, lambda f: f["status"] == "negated"), lambda f: f["name"])
    meds = medications(F.coalesce(section_text(parts, MEDICATION_SECTION), F.lit("")))
    extracted = split.select(
        "note_id",
        "sections",
        found.alias("_found"),
        meds.alias("medication_details"),
        social_signals(low).alias("sdoh_signals"),
        referrals(low).alias("referrals"),
        follow_ups(F.col("_note")).alias("follow_up_requirements"),
    )
    return extracted.select(
        "note_id",
        "sections",
        kept(F.col("_found")).alias("diagnoses"),
        negated(F.col("_found")).alias("negated_conditions"),
        medication_entities(F.col("medication_details")).alias("medications"),
        "medication_details",
        "sdoh_signals",
        "referrals",
        "follow_up_requirements",
    )


def _with_status(status: str) -> Column:
    return F.transform(F.filter("diagnoses", lambda d: d["assertion"] == status), lambda d: d["text"])


def by_assertion(annotated: DataFrame) -> DataFrame:
    """Diagnoses by status, distinct negated conditions and social risks in words."""
    words = F.create_map(*[F.lit(x) for pair in SOCIAL_DESCRIPTIONS.items() for x in pair])
    return annotated.select(
        "note_id",
        _with_status("confirmed").alias("confirmed"),
        _with_status("historical").alias("historical"),
        _with_status("possible").alias("possible"),
        F.array_sort(F.array_distinct("negated_conditions")).alias("negated"),
        F.transform("sdoh_signals", lambda s: F.coalesce(F.try_element_at(words, s), s)).alias("social_risks"),
    )


def _confirmed_mentions(*words: str) -> Column:
    def mentioned(d: Column) -> Column:
        return (d["assertion"] == "confirmed") & any_true([F.contains(F.lower(d["text"]), F.lit(w)) for w in words])

    return F.exists("diagnoses", mentioned)


def _signal(name: str) -> Column:
    return F.array_contains("sdoh_signals", name)


def readmission_flags(annotated: DataFrame) -> DataFrame:
    """Readable risk flags of a note. Texts are fixed values."""
    n = F.size("referrals")
    flags = [
        F.when(_signal("social_isolation"), "Patient lives alone — high social vulnerability"),
        F.when(_signal("financial_stress"), "Financial stress — medication non-compliance risk"),
        F.when(_signal("medication_non_compliance"), "Documented medication non-compliance"),
        F.when(_confirmed_mentions("diabetes"), "Active diabetes — chronic disease management need"),
        F.when(
            _confirmed_mentions("nephropathy", "ckd", "renal"), "Kidney disease — requires nephrology follow-up"
        ),
        F.when(
            n >= 2,
            F.concat(n.cast("string"), F.lit(" referrals placed — complex discharge requiring coordination")),
        ),
    ]
    return annotated.select("note_id", compact(flags).alias("risk_flags"))


def note_features(annotated: DataFrame) -> DataFrame:
    """The twelve model features of a note."""

    def denied(*words: str) -> Column:
        return F.exists("negated_conditions", lambda t: any_true([F.contains(F.lower(t), F.lit(w)) for w in words]))

    n = F.size("referrals")
    features = {
        "nlp_social_isolation": _signal("social_isolation"),
        "nlp_financial_stress": _signal("financial_stress"),
        "nlp_medication_noncompliance": _signal("medication_non_compliance"),
        "nlp_food_insecurity": _signal("food_insecurity"),
        "nlp_has_diabetes": _confirmed_mentions("diabetes"),
        "nlp_has_nephropathy": _confirmed_mentions("nephropathy", "kidney"),
        "nlp_has_hypertension": _confirmed_mentions("hypertension", "hypertensive"),
        "nlp_num_referrals": n,
        "nlp_complex_discharge": n >= 2,
        "nlp_denies_chest_pain": denied("chest pain"),
        "nlp_denies_shortness_of_breath": denied("shortness of breath", "sob"),
        "nlp_sdoh_risk_score": F.size("sdoh_signals"),
    }
    return annotated.select("note_id", *[c.cast("int").alias(name) for name, c in features.items()])
