"""DuckDB twins for the note queries.

RE2 knows ASCII word boundaries only, so boundaries are spelled out as "not next to a letter, digit
or underscore".
"""

from carepanel.sources.fixture_views import duck_cte

NOTES = duck_cte("notes")
WORD = "[\\p{L}\\p{N}_]"
NOT_WORD = "[^\\p{L}\\p{N}_]"


def has(text, phrases):
    body = "|".join(phrases)
    return f"regexp_matches({text}, '(^|{NOT_WORD})({body})($|{NOT_WORD})')"


NEG = ["no", "not", "without", "denies?", "denied", "free of", "no evidence of", "negative for", "rules? out", "ruled out", "absent", "never", "none"]
SPEC = ["possible", "possibly", "probable", "probably", "suspects?", "suspected", "cannot exclude", "consistent with", "concerns? for", "may be", "might be",
        "rule out", "question of"]
HIST = ["history of", "h/o", "past medical history", "previously", "prior", "former", "past", "old", "chronic"]
TERM = ["but", "however", "except", "though", "although", "whereas", "nevertheless"]

HEADERS = {
    "chief_complaint": "chief complaint[s]|cc", "history_of_present_illness": "history of present illness|hpi",
    "past_medical_history": "past medical history|pmh|medical history", "medications": "medications? on admission|current medications|home medications",
    "allergies": "(drug )?allergie?s", "physical_exam": "physical examination|pe|vitals",
    "laboratory_results": "lab(oratory)? (results?|data|values?|findings?)|labs", "assessment_and_plan": "assessment and plan|assessment/plan|a/p|impression",
    "follow_up": "follow.?up|f/u", "discharge": "discharge (condition|disposition|instructions?|summary)",
}
WS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(133), chr(160))"
_HEAD = "CASE " + " ".join(f"WHEN regexp_full_match(cand, '{p}') THEN '{s}'" for s, p in HEADERS.items()) + " END"

LINES = f"""lines AS (SELECT note_id, CAST(i - 1 AS INT) AS line_no, l[i] AS line FROM (SELECT note_id, string_split(note_text, chr(10)) AS l FROM fx_notes), unnest(range(1, len(l) + 1)) AS u(i)),
heads AS (SELECT *, {_HEAD} AS section FROM (SELECT *, trim(rtrim(trim(lower(line), {WS}), ':'), {WS}) AS cand FROM lines)),
runs AS (SELECT *, count(section) OVER (PARTITION BY note_id ORDER BY line_no) AS run FROM heads),
blocks AS (SELECT note_id, run, coalesce(max(section), 'unknown') AS section, string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE section IS NULL) AS section_text,
  count(*) FILTER (WHERE section IS NULL) AS n FROM runs GROUP BY note_id, run),
secs AS (SELECT note_id, section, section_text FROM blocks WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY note_id, section ORDER BY run DESC) = 1)"""

SYN = {
    "Type 2 Diabetes": ["type 2 diabetes", "t2dm", "dm type 2", "diabetes mellitus", "dm2"],
    "Hypertension": ["hypertension", "htn", "high blood pressure", "hypertensive"],
    "Heart Failure": ["heart failure", "hf", "chf", "cardiac failure"],
    "CKD": ["chronic kidney disease", "ckd", "renal insufficiency", "nephropathy"],
    "COPD": ["copd", "chronic obstructive pulmonary"],
    "Atrial Fibrillation": ["atrial fibrillation", "afib", "a-fib"],
    "Coronary Artery Disease": ["coronary artery disease", "cad", "coronary disease"],
}
_SYN_ROWS = ", ".join(f"({d}, '{n}', {i}, '{s}')" for d, (n, ss) in enumerate(SYN.items()) for i, s in enumerate(ss))
_LEX_ROWS = ", ".join([f"('{s}', 'DISEASE')" for ss in SYN.values() for s in ss] + [f"('{s}', 'FINDING')" for s in ("chest pain", "shortness of breath", "sob", "kidney")])

LOW = "low AS (SELECT note_id, lower(note_text) AS t FROM fx_notes)"
DICT = f"""syn AS (SELECT * FROM (VALUES {_SYN_ROWS}) s(d, name, i, term)),
dic AS (SELECT note_id, d, name, CASE WHEN {has('pre', ['no', 'not', 'no history of', 'denies?', 'no known'])} THEN 'negated' WHEN {has('pre', ['history of', 'h/o', 'past medical'])} THEN 'historical'
  ELSE 'confirmed' END AS status FROM (SELECT note_id, d, name, substr(t, greatest(1, p - 50), least(50, p - 1)) AS pre FROM (
    SELECT note_id, d, name, t, instr(t, term) AS p FROM low, syn WHERE contains(t, term) QUALIFY row_number() OVER (PARTITION BY note_id, d ORDER BY i) = 1)))"""

SOCIAL = {
    "social_isolation": "lives? alone|no social support|limited social support|socially isolated|no family support",
    "financial_stress": "financial (concern|stress|difficult|problem)|afford(ing)? medication|cost of medication|cannot afford|financial (strain|burden)|lost (employment|job|work)|unemployed",
    "housing_instability": "homeless|unstable housing|shelter|no fixed address|housing (concern|issue|problem)",
    "food_insecurity": "food insecurity|food desert|cannot afford food|nutritional (concern|deficit)|dietary (non-compliance|non-adherence)",
    "transportation": "no transportation|transportation (barrier|issue|concern)|cannot drive|no car",
    "medication_non_compliance": "medication non.?compliance|medication non.?adherence|not taking (medication|med|drug)|stopped taking|ran out of|unable to afford",
    "substance_use": "alcohol (abuse|use|dependence)|substance (abuse|use disorder)|tobacco (use|abuse)|smoking",
}
DESCRIPTION = {
    "social_isolation": "Lives alone / limited social support", "financial_stress": "Financial stress / medication cost concerns",
    "housing_instability": "Housing instability", "food_insecurity": "Food insecurity", "transportation": "Transportation barriers",
    "medication_non_compliance": "Medication non-compliance", "substance_use": "Substance use",
}


def _social(words):
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{words(c)}' END" for c, p in SOCIAL.items()) + "], lambda x: x IS NOT NULL)"


SIG = f"sig AS (SELECT note_id, {_social(lambda c: c)} AS s, {_social(DESCRIPTION.get)} AS w FROM low)"

_END = "(?:\\.|\\n?\\z)"
_REF = [f"referral? (?:placed?|ordered?|to) (?:to )?(.+?){_END}", f"referred? to (.+?){_END}", f"consult(?:ation)? (?:placed?|ordered?) (?:for|to|with) (.+?){_END}"]
REFS = f"""refx AS (SELECT note_id, list_concat({", ".join(f"regexp_extract_all(t, '{p}', 1)" for p in _REF)}) AS r FROM low),
refs AS (SELECT note_id, list_sort(list_distinct(list_transform(list_filter(list_transform(r, lambda x: trim(x, {WS})), lambda x: length(x) < 100),
  lambda x: array_to_string(list_transform(regexp_extract_all(x, '\\p{{L}}+|\\P{{L}}+'), lambda y: concat(upper(y[1]), y[2:])), '')))) AS r FROM refx)"""

FOLLOW = f"""fol AS (SELECT note_id, list_filter(list_transform(string_split(regexp_extract(note_text, '(?is)follow.?up:?\\n(.+?)(?:\\n\\n|\\z)', 1), chr(10)), lambda x: trim(x, {WS})),
  lambda x: length(x) > 5) AS f FROM fx_notes)"""

_P2 = "(?i)(\\b[A-Z][a-z]+(?:in|ol|ide|ate|ine|one|pril|sartan|stat|mab)?)\\s+(\\d+(?:\\.\\d+)?(?:mg|mcg|g|ml|units?))"
_P1 = _P2 + "\\s+((?:once|twice|three times?|four times?|BID|TID|QID|QD|daily|weekly|PRN|as needed)(?:\\s+daily)?)"


def meds(src):
    """src offers note_id, line_no, line; returns parsed medication rows with n from 0 per note."""
    words = " OR ".join(f"contains(lower(t), '{w}')" for w in ("mg", "mcg", "daily", "bid", "tid", "prn", "tablet", "capsule"))
    g = lambda i: f"CASE WHEN regexp_matches(t, '{_P1}') THEN regexp_extract(t, '{_P1}', {i}) WHEN regexp_matches(t, '{_P2}') THEN regexp_extract(t, '{_P2}', {i}) ELSE 'unstructured' END"
    f = f"CASE WHEN regexp_matches(t, '{_P1}') THEN regexp_extract(t, '{_P1}', 3) WHEN regexp_matches(t, '{_P2}') THEN 'unspecified' ELSE 'unstructured' END"
    return f"""(SELECT note_id, CAST(row_number() OVER (PARTITION BY note_id ORDER BY line_no) - 1 AS INT) AS n, {g(1)} AS name, {g(2)} AS dose, {f} AS frequency, t AS original_text
      FROM (SELECT note_id, line_no, regexp_replace(trim(line, {WS}), '^\\d+\\.?\\s*', '') AS t FROM {src} WHERE trim(line, {WS}) <> '')
      WHERE regexp_matches(t, '{_P2}') OR {words})"""


MED_SRC = "(SELECT note_id, i AS line_no, l[i] AS line FROM (SELECT note_id, string_split(section_text, chr(10)) AS l FROM secs WHERE section = 'medications'), unnest(range(1, len(l) + 1)) AS u(i))"
MED = f"med AS {meds(MED_SRC)}"


def assertion(entity, section):
    p = f"instr(lower(s), {entity})"
    pre = f"substr(lower(s), greatest(1, {p} - 50), least(50, {p} - 1))"
    stop = has(pre, TERM)
    return f"""CASE WHEN {p} = 0 THEN 'confirmed' WHEN {section} = 'past_medical_history' AND {has(pre, HIST)} AND NOT {stop} THEN 'historical'
      WHEN {has(pre, NEG)} AND NOT {stop} THEN 'negated' WHEN {has(pre, SPEC)} AND NOT {stop} THEN 'possible'
      WHEN {section} = 'past_medical_history' THEN 'historical' ELSE 'confirmed' END"""


ENT = f"""lex AS (SELECT * FROM (VALUES {_LEX_ROWS}) x(term, kind)),
sents AS (SELECT note_id, section, trim(s, {WS}) AS s FROM (SELECT note_id, section, unnest(regexp_extract_all(section_text, '[^.!?\\n]+[.!?]?')) AS s FROM secs
  WHERE section IN ('assessment_and_plan', 'past_medical_history', 'history_of_present_illness', 'chief_complaint')) WHERE trim(s, {WS}) <> ''),
ents AS (SELECT note_id, term AS text, kind AS entity_type, {assertion('term', 'section')} AS assertion, section, s AS sentence FROM sents JOIN lex ON contains(lower(s), term))"""

_J = lambda c: f"array_to_string({c}, ' | ')"
BASE = f"WITH {NOTES}, {LOW}, "
DIAG = """dg AS (SELECT note_id, coalesce(list(concat(name, ':', status) ORDER BY d) FILTER (WHERE status <> 'negated'), []) AS diagnoses,
  coalesce(list(name ORDER BY d) FILTER (WHERE status = 'negated'), []) AS negated, coalesce(list(name ORDER BY d) FILTER (WHERE status = 'confirmed'), []) AS confirmed,
  coalesce(list(name ORDER BY d) FILTER (WHERE status = 'historical'), []) AS historical FROM (SELECT note_id FROM low) a LEFT JOIN dic USING (note_id) GROUP BY note_id)"""
ALL = f"{BASE}{LINES}, {DICT}, {SIG}, {REFS}, {FOLLOW}, {MED}, {DIAG} "
_FEATURES = """SELECT low.note_id, CAST(list_contains(s, 'social_isolation') AS INT) AS nlp_social_isolation, CAST(list_contains(s, 'financial_stress') AS INT) AS nlp_financial_stress,
  CAST(list_contains(s, 'medication_non_compliance') AS INT) AS nlp_medication_noncompliance, CAST(list_contains(s, 'food_insecurity') AS INT) AS nlp_food_insecurity,
  {dm} AS nlp_has_diabetes, {ne} AS nlp_has_nephropathy, {ht} AS nlp_has_hypertension, CAST(len(r) AS INT) AS nlp_num_referrals, CAST(len(r) >= 2 AS INT) AS nlp_complex_discharge,
  {cp} AS nlp_denies_chest_pain, {sb} AS nlp_denies_shortness_of_breath, CAST(len(s) AS INT) AS nlp_sdoh_risk_score FROM low JOIN sig USING (note_id) JOIN refs USING (note_id) {extra}"""


def _any_entity(status, *words):
    cond = " OR ".join(f"contains(text, '{w}')" for w in words)
    return f"CAST(EXISTS (SELECT 1 FROM ents WHERE ents.note_id = low.note_id AND assertion = '{status}' AND ({cond})) AS INT)"


CHECKS = {
    "b01_section_headers": f"WITH {NOTES}, {LINES} SELECT note_id, line_no, section FROM heads WHERE section IS NOT NULL",
    "b02_sections": f"WITH {NOTES}, {LINES} SELECT note_id, section, section_text FROM secs",
    "b03_assertions": f"""WITH {NOTES}, sx AS (SELECT note_id, l[i] AS s, CAST(i - 1 AS INT) AS n FROM (SELECT note_id, regexp_extract_all(note_text, '[^.!?\\n]+[.!?]?') AS l FROM fx_notes), unnest(range(1, len(l) + 1)) AS u(i))
        SELECT note_id, n, {assertion("'a'", "'chief_complaint'")} AS elsewhere, {assertion("'a'", "'past_medical_history'")} AS in_history FROM sx""",
    "b04_lexicon_entities": f"WITH {NOTES}, {LINES}, {ENT} SELECT *, CAST(1 AS DOUBLE) AS confidence FROM ents",
    "b05_social_signals": f"{BASE}{SIG} SELECT note_id, {_J('s')} AS sdoh_signals FROM sig",
    "b06_referrals": f"{BASE}{REFS} SELECT note_id, {_J('r')} AS referrals FROM refs",
    "b07_follow_ups": f"WITH {NOTES}, {FOLLOW} SELECT note_id, {_J('f')} AS follow_ups FROM fol",
    "b08_medications": f"WITH {NOTES}, {LINES}, {MED} SELECT * FROM med",
    "b08_medication_lines": f"WITH {NOTES}, {LINES} SELECT * FROM {meds('lines')}",
    "b09_medication_entities": f"WITH {NOTES}, {LINES}, {MED} SELECT note_id, original_text AS text, 'MEDICATION' AS entity_type, 'confirmed' AS assertion, 'medications' AS section FROM med",
    "b10_dictionary_diagnoses": f"{BASE}{DICT} SELECT note_id, name, status FROM dic",
    "b11_note_results": ALL + f"""SELECT low.note_id, (SELECT CAST(count(*) AS INT) FROM secs x WHERE x.note_id = low.note_id) AS num_sections, {_J('diagnoses')} AS diagnoses, {_J('negated')} AS negated_conditions,
        coalesce((SELECT string_agg(original_text, ' | ' ORDER BY n) FROM med x WHERE x.note_id = low.note_id), '') AS medications, {_J('s')} AS sdoh_signals, {_J('r')} AS referrals, {_J('f')} AS follow_ups
        FROM low JOIN dg USING (note_id) JOIN sig USING (note_id) JOIN refs USING (note_id) JOIN fol USING (note_id)""",
    "b12_by_assertion": ALL + f"""SELECT note_id, {_J('confirmed')} AS confirmed, {_J('historical')} AS historical, '' AS possible, {_J('list_sort(negated)')} AS negated, {_J('w')} AS social_risks
        FROM dg JOIN sig USING (note_id)""",
    "b13_readmission_flags": ALL + f"""SELECT note_id, {_J('''list_filter([CASE WHEN list_contains(s, 'social_isolation') THEN 'Patient lives alone — high social vulnerability' END,
        CASE WHEN list_contains(s, 'financial_stress') THEN 'Financial stress — medication non-compliance risk' END,
        CASE WHEN list_contains(s, 'medication_non_compliance') THEN 'Documented medication non-compliance' END,
        CASE WHEN list_contains(confirmed, 'Type 2 Diabetes') THEN 'Active diabetes — chronic disease management need' END,
        CASE WHEN list_contains(confirmed, 'CKD') THEN 'Kidney disease — requires nephrology follow-up' END,
        CASE WHEN len(r) >= 2 THEN concat(CAST(len(r) AS STRING), ' referrals placed — complex discharge requiring coordination') END], lambda x: x IS NOT NULL)''')} AS risk_flags
        FROM dg JOIN sig USING (note_id) JOIN refs USING (note_id)""",
    "b14_note_features": ALL + _FEATURES.format(
        dm="CAST(list_contains(confirmed, 'Type 2 Diabetes') AS INT)", ne="0", ht="CAST(list_contains(confirmed, 'Hypertension') AS INT)", cp="0", sb="0",
        extra="JOIN dg USING (note_id)"),
    "b14_note_features_lexicon": f"{BASE}{LINES}, {SIG}, {REFS}, {ENT} " + _FEATURES.format(
        dm=_any_entity("confirmed", "diabetes"), ne=_any_entity("confirmed", "nephropathy", "kidney"), ht=_any_entity("confirmed", "hypertension", "hypertensive"),
        cp=_any_entity("negated", "chest pain"), sb=_any_entity("negated", "shortness of breath", "sob"), extra=""),
}
