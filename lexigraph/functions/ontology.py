"""The clinical ontology: fixed values of the data model, and their DataFrame forms.

Lines of a table read `name: value; value; ...` in the order that counts where order decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: they must equal the published data model for results to agree ----

ENTITY_LABELS = """
DISEASE_DISORDER SIGN_SYMPTOM SEVERITY MEDICATION DOSAGE FREQUENCY ADMINISTRATION THERAPEUTIC_PROCEDURE DIAGNOSTIC_PROCEDURE LAB_VALUE
BIOLOGICAL_STRUCTURE BIOLOGICAL_ATTRIBUTE AREA AGE SEX WEIGHT HEIGHT OCCUPATION PERSONAL_BACKGROUND FAMILY_HISTORY DATE DURATION TIME MASS VOLUME
DISTANCE QUANTITATIVE_CONCEPT QUALITATIVE_CONCEPT CLINICAL_EVENT HISTORY OUTCOME DETAILED_DESCRIPTION OTHER_ENTITY OTHER_EVENT ACTIVITY COLOR SHAPE
TEXTURE SUBJECT COREFERENCE NONBIOLOGICAL_LOCATION
""".split()

RELATION_LABELS = """
CAUSES TREATS INDICATES ASSOCIATED_WITH AFFECTS DIAGNOSES QUANTIFIES DURATION_OF ADMINISTERED_AS RISK_FACTOR_OF LOCATED_IN HAS_SYMPTOM HAS_SEVERITY
GIVEN_FOR HAS_DOSAGE HAS_FREQUENCY HAS_ADMINISTRATION PERFORMED_ON OCCURS_AT HAS_DURATION RESULTS_IN LEADS_TO PERFORMED_IN REVEALS MEASURES
IS_VALUE_OF CONTAINS HAS_COLOR HAS_SHAPE HAS_TEXTURE HAS_MASS HAS_VOLUME PREVIOUSLY_OCCURRED DESCRIBES RELATED_TO HISTORY_OF HAS_AGE HAS_SEX
HAS_WEIGHT HAS_HEIGHT HAS_OCCUPATION HAS_PERSONAL_BACKGROUND HAS_FAMILY_HISTORY
""".split()

LEXICON_TEXT = """
SUBJECT: patient; subject; individual; person; case
SEX: male; female; man; woman; boy; girl
COLOR: red; blue; yellow; white; black; green; brown; pink; orange; purple; gray; grey
SHAPE: round; oval; square; rectangular; triangular; irregular; spherical; elongated
TEXTURE: rough; smooth; hard; soft; firm; granular
THERAPEUTIC_PROCEDURE: excised; excision; removed; removal; resected; resection; drained; drainage; aspirated; aspiration; ablated; ablation; amputated; amputation; transplanted; transplant; ligated; ligation; sutured; cauterized; surgery; operation
DIAGNOSTIC_PROCEDURE: MRI; CT scan; ultrasound; X-ray; xray; endoscopy; colonoscopy; biopsy; ECG; EKG; EEG; blood test; urinalysis; examined; examination; palpated; palpation; auscultated; auscultation
"""

PATTERN_TEXT = r"""
AGE: \b\d{1,3}\s*(?:years?|y\.?o\.?|months?\s+old)\b
DURATION: \b\d{1,3}\s*(?:years?|months?|weeks?|days?|hours?)\b
WEIGHT: \b\d{1,3}(?:\.\d+)?\s*kg\b
HEIGHT: \b\d{2,3}(?:\.\d+)?\s*cm\b
MASS: \b\d{1,4}(?:\.\d+)?\s*(?:g|grams?)\b
VOLUME: \b\d{1,4}(?:\.\d+)?\s*(?:ml|cc|litres?|liters?)\b
"""

FORWARD_TEXT = """
CAUSES: leads to; leading to; causes; triggers; induces; produces; results in
ASSOCIATED_WITH: associated with; in the context of; related to; linked to; in association with; coexisting with; concurrent with; concomitant with; accompanied by; coexistent with; in combination with; together with
INDICATES: consistent with; indicating; indicates; suggesting; suggests; reveals; showing; positive for; revealing; reflects; elevated in
AFFECTS: affecting; involves; involving; damages; damaging; impairs; impairing; spreads to; metastasized to
RISK_FACTOR_OF: increases risk of; increased risk of; predisposes to; predisposed to
LOCATED_IN: located in; found in; present in; within the; in the region of; in the area of
QUANTIFIES: measuring; measured at; of
DURATION_OF: ago; since; since diagnosis; years ago; months ago; weeks ago; days ago
HAS_SYMPTOM: presents with; presenting with; manifests as; manifesting as; characterized by; accompanied by; has symptom
HAS_SEVERITY: graded as; rated as; classified as; of severity; with severity
TREATS: treats; used to treat; therapy for; treatment for; manages; reduces; controls; alleviates
GIVEN_FOR: given for; prescribed for; indicated for; administered for; used for
HAS_DOSAGE: at a dose of; at dose; dosed at; given at; administered at; taken at
HAS_FREQUENCY: once daily; twice daily; three times daily; per day; every day; every other day; weekly; monthly
HAS_ADMINISTRATION: administered; given; taken; orally; intravenously; subcutaneously; intramuscularly; via
PERFORMED_ON: performed on; done on; carried out on; conducted on; applied to
OCCURS_AT: occurred at; scheduled at; performed at; happened at
HAS_DURATION: lasting; lasting for; for a duration of; over a period of; duration of
RESULTS_IN: results in; resulted in; led to outcome
LEADS_TO: leads to; led to; culminated in
PERFORMED_IN: performed in; done in; carried out in; conducted in
REVEALS: reveals; revealed; detects; detected; demonstrates; demonstrates presence of
MEASURES: measures; measuring; quantifies; quantifying
IS_VALUE_OF: is value of; is the result of; corresponds to; obtained from
CONTAINS: contains; includes; comprises
PREVIOUSLY_OCCURRED: previously occurred; occurred previously; past occurrence of
DESCRIBES: describes; describing; details; elaborates on
RELATED_TO: related to; linked to; connected to; pertaining to
HISTORY_OF: history of; past history of; prior history of; known history of
HAS_AGE: aged; age of; years old; year-old
HAS_SEX: is male; is female; male patient; female patient; sex is
HAS_WEIGHT: weighs; weight of; body weight of
HAS_HEIGHT: height of; stands
HAS_OCCUPATION: works as; employed as; occupation is
HAS_PERSONAL_BACKGROUND: background of; with a background; social history of
HAS_FAMILY_HISTORY: family history of; family member with; father had; mother had; sibling with
HAS_MASS: with mass; of mass; with a mass of; weighing; mass of
HAS_VOLUME: with volume; of volume; with a volume of; volume of; measuring
"""

INVERTED_TEXT = """
CAUSES: due to; caused by; secondary to; as a result of; resulting from; triggered by; induced by; attributed to
TREATS: treated with; treatment with; therapy with; managed with; management with; underwent; prescribed; treated by; received; on therapy with
DIAGNOSES: diagnosed with; diagnosis of; identified as; confirmed as; detected by; found to have; presenting with; presenting as
INDICATES: confirmed by; revealed by; shown by; evidenced by
DURATION_OF: for the last; for the past; over the last; over the past; in the last; in the past; during the last; during the past; over; for
ADMINISTERED_AS: at a dose of; at dose; dosed at; given at; administered at; taken at; once daily; twice daily; three times daily; per day; mg daily; mg twice; orally; intravenously; subcutaneously; intramuscularly
RISK_FACTOR_OF: risk factor for; history of; family history of; prior history of
HAS_SEVERITY: severity of; grade of; rated as
HAS_DURATION: for the last; for the past; over the last; over the past; in the last; in the past; during the last; during the past
OCCURS_AT: on the date of; at the time of; during
REVEALS: diagnosed with; diagnosis of; shown by; detected by; confirmed by; found to have
PERFORMED_IN: in the setting of; at the facility of
"""

#: Verb lemmas of each relation.
VERB_TEXT = """
CAUSES: cause; lead; result; trigger; induce; produce; develop; provoke
TREATS: treat; manage; cure; prescribe; administer; receive; undergo; reduce; alleviate; control
ASSOCIATED_WITH: associate; correlate; relate; coexist; accompany
INDICATES: indicate; suggest; reflect; confirm
AFFECTS: affect; involve; damage; impair; spread; invade; compromise
DIAGNOSES: diagnose; detect; identify; find; present
RISK_FACTOR_OF: predispose; increase
HAS_SYMPTOM: manifest; exhibit
REVEALS: reveal; show; demonstrate
MEASURES: measure
QUANTIFIES: quantify
PERFORMED_ON: perform; conduct; apply
OCCURS_AT: occur; happen; schedule
LEADS_TO: culminate
LOCATED_IN: locate; lie
CONTAINS: contain; comprise
DESCRIBES: describe; detail; explain
"""

PROTOTYPE_TEXT = """
CAUSES: X causes Y. X leads to Y. X results in Y. X triggers Y. X produces Y. X induces Y.
TREATS: X treats Y. X is used to treat Y. X is therapy for Y. X manages Y. X cures Y. X reduces Y. X controls Y.
ASSOCIATED_WITH: X is associated with Y. X is related to Y. X correlates with Y. X is linked to Y. X co-occurs with Y. X coexists with Y.
AFFECTS: X affects Y. X involves Y. X damages Y. X impairs Y. X impacts Y. X disrupts Y. X spreads to Y. X invades Y.
DIAGNOSES: X diagnoses Y. X detects Y. X confirms Y. X reveals Y. X identifies Y. X presents with Y.
INDICATES: X indicates Y. X is a marker of Y. X suggests Y. X is consistent with Y. X shows Y. X reflects Y. X is elevated in Y.
QUANTIFIES: X measures Y. X is the value of Y. X quantifies Y. X is the amount of Y. X is the level of Y.
DURATION_OF: X is the duration of Y. X is how long Y lasted. Y occurred over X. Y persisted for X.
ADMINISTERED_AS: X is administered as Y. X is given at dose Y. X is taken Y. X is dosed Y. X is prescribed at Y.
RISK_FACTOR_OF: X is a risk factor for Y. X predisposes to Y. X increases risk of Y. X is associated with higher risk of Y.
LOCATED_IN: X is located in Y. X is found in Y. X is present in Y. X is within Y. X is part of Y.
HAS_SYMPTOM: X has symptom Y. X presents with Y. X is characterized by Y. X manifests as Y.
HAS_SEVERITY: X has severity Y. X is Y in severity. X is graded as Y. X is classified as Y.
GIVEN_FOR: X is given for Y. X is prescribed for Y. X is indicated for Y. X is administered for Y.
HAS_DOSAGE: X has dosage Y. X is given at dose Y. X is dosed at Y. X is taken at Y.
HAS_FREQUENCY: X has frequency Y. X is taken Y. X is given Y times per day. X is administered Y.
HAS_ADMINISTRATION: X is administered as Y. X is given via Y. X is taken Y. X is delivered by Y route.
PERFORMED_ON: X is performed on Y. X is done on Y. X is applied to Y. X is conducted on Y.
OCCURS_AT: X occurs at Y. X is scheduled at Y. X happened at Y. X took place at Y.
HAS_DURATION: X has duration Y. X lasted for Y. X continued for Y. X persisted over Y.
RESULTS_IN: X results in Y. X led to outcome Y. X produced outcome Y. X culminated in Y.
LEADS_TO: X leads to Y. X led to Y. X resulted in Y. X culminated in Y.
PERFORMED_IN: X is performed in Y. X is done in Y. X took place in Y. X was conducted at Y.
REVEALS: X reveals Y. X detected Y. X identifies Y. X demonstrates Y. X confirms the presence of Y.
MEASURES: X measures Y. X is the measurement of Y. X quantifies Y. X is the amount of Y.
IS_VALUE_OF: X is the value of Y. X is the result of Y. X corresponds to Y. X was obtained from Y.
CONTAINS: X contains Y. X includes Y. X comprises Y.
HAS_COLOR: X has color Y. X appears Y. X is colored Y.
HAS_SHAPE: X has shape Y. X is Y shaped. X appears Y in shape.
HAS_TEXTURE: X has texture Y. X feels Y. X is Y in texture.
HAS_MASS: X has mass Y. X has a mass of Y grams. X weighs Y.
HAS_VOLUME: X has volume Y. X has a volume of Y. X measures Y in volume.
PREVIOUSLY_OCCURRED: X previously occurred Y. X had a prior event of Y. X had past occurrence of Y.
DESCRIBES: X describes Y. X gives a description of Y. X details Y. X explains Y.
RELATED_TO: X is related to Y. X is linked to Y. X pertains to Y.
HISTORY_OF: X has history of Y. X had Y in the past. X has prior history of Y. X previously had Y.
HAS_AGE: X has age Y. X is Y years old. X is aged Y.
HAS_SEX: X has sex Y. X is Y. X is a Y patient.
HAS_WEIGHT: X has weight Y. X weighs Y. X has a body weight of Y.
HAS_HEIGHT: X has height Y. X stands Y tall. X is Y in height.
HAS_OCCUPATION: X has occupation Y. X works as Y. X is employed as Y.
HAS_PERSONAL_BACKGROUND: X has personal background Y. X has a social history of Y.
HAS_FAMILY_HISTORY: X has family history of Y. X has a family member with Y.
"""

#: Relations that a pair of labels may have.
LICENCE_TEXT = """
DISEASE_DISORDER DISEASE_DISORDER: ASSOCIATED_WITH; CAUSES
DISEASE_DISORDER SIGN_SYMPTOM: CAUSES; ASSOCIATED_WITH; HAS_SYMPTOM
SIGN_SYMPTOM DISEASE_DISORDER: CAUSES; ASSOCIATED_WITH; INDICATES
SIGN_SYMPTOM SIGN_SYMPTOM: ASSOCIATED_WITH
DISEASE_DISORDER SEVERITY: HAS_SEVERITY
SIGN_SYMPTOM SEVERITY: HAS_SEVERITY
DISEASE_DISORDER COLOR: HAS_COLOR
DISEASE_DISORDER SHAPE: HAS_SHAPE
DISEASE_DISORDER TEXTURE: HAS_TEXTURE
SIGN_SYMPTOM COLOR: HAS_COLOR
SIGN_SYMPTOM SHAPE: HAS_SHAPE
SIGN_SYMPTOM TEXTURE: HAS_TEXTURE
MEDICATION DISEASE_DISORDER: TREATS; CAUSES; GIVEN_FOR
MEDICATION SIGN_SYMPTOM: TREATS; CAUSES
THERAPEUTIC_PROCEDURE DISEASE_DISORDER: TREATS; CAUSES
THERAPEUTIC_PROCEDURE SIGN_SYMPTOM: TREATS; CAUSES
ACTIVITY SIGN_SYMPTOM: CAUSES; ASSOCIATED_WITH
ACTIVITY DISEASE_DISORDER: CAUSES; ASSOCIATED_WITH
DISEASE_DISORDER MEDICATION: TREATS
DISEASE_DISORDER THERAPEUTIC_PROCEDURE: TREATS
SIGN_SYMPTOM MEDICATION: TREATS
SIGN_SYMPTOM THERAPEUTIC_PROCEDURE: TREATS
MEDICATION DOSAGE: ADMINISTERED_AS; HAS_DOSAGE
MEDICATION FREQUENCY: ADMINISTERED_AS; HAS_FREQUENCY
MEDICATION ADMINISTRATION: ADMINISTERED_AS; HAS_ADMINISTRATION
MEDICATION DURATION: DURATION_OF
THERAPEUTIC_PROCEDURE BIOLOGICAL_STRUCTURE: PERFORMED_ON
THERAPEUTIC_PROCEDURE AREA: PERFORMED_ON
THERAPEUTIC_PROCEDURE DATE: OCCURS_AT
THERAPEUTIC_PROCEDURE TIME: OCCURS_AT
THERAPEUTIC_PROCEDURE DURATION: DURATION_OF; HAS_DURATION
THERAPEUTIC_PROCEDURE OUTCOME: RESULTS_IN
DIAGNOSTIC_PROCEDURE DISEASE_DISORDER: DIAGNOSES; REVEALS
DIAGNOSTIC_PROCEDURE SIGN_SYMPTOM: DIAGNOSES; REVEALS
DIAGNOSTIC_PROCEDURE LAB_VALUE: MEASURES
DIAGNOSTIC_PROCEDURE BIOLOGICAL_STRUCTURE: PERFORMED_ON
DIAGNOSTIC_PROCEDURE AREA: PERFORMED_ON
DIAGNOSTIC_PROCEDURE DATE: OCCURS_AT
DIAGNOSTIC_PROCEDURE TIME: OCCURS_AT
DIAGNOSTIC_PROCEDURE DURATION: HAS_DURATION
DISEASE_DISORDER DIAGNOSTIC_PROCEDURE: DIAGNOSES
LAB_VALUE DISEASE_DISORDER: INDICATES
LAB_VALUE SIGN_SYMPTOM: INDICATES; QUANTIFIES
LAB_VALUE DIAGNOSTIC_PROCEDURE: IS_VALUE_OF
DISEASE_DISORDER LAB_VALUE: INDICATES
SIGN_SYMPTOM LAB_VALUE: QUANTIFIES
DISEASE_DISORDER BIOLOGICAL_STRUCTURE: AFFECTS; LOCATED_IN
DISEASE_DISORDER AREA: AFFECTS; LOCATED_IN
SIGN_SYMPTOM BIOLOGICAL_STRUCTURE: AFFECTS; LOCATED_IN
SIGN_SYMPTOM AREA: LOCATED_IN
BIOLOGICAL_STRUCTURE AREA: LOCATED_IN
BIOLOGICAL_STRUCTURE COLOR: HAS_COLOR
BIOLOGICAL_STRUCTURE SHAPE: HAS_SHAPE
BIOLOGICAL_STRUCTURE TEXTURE: HAS_TEXTURE
AREA BIOLOGICAL_STRUCTURE: CONTAINS
WEIGHT SIGN_SYMPTOM: QUANTIFIES
WEIGHT DISEASE_DISORDER: QUANTIFIES; INDICATES
MASS SIGN_SYMPTOM: QUANTIFIES
MASS DISEASE_DISORDER: QUANTIFIES; INDICATES
VOLUME SIGN_SYMPTOM: QUANTIFIES
VOLUME DISEASE_DISORDER: QUANTIFIES; INDICATES
QUANTITATIVE_CONCEPT SIGN_SYMPTOM: QUANTIFIES
QUANTITATIVE_CONCEPT DISEASE_DISORDER: QUANTIFIES; INDICATES
BIOLOGICAL_STRUCTURE MASS: HAS_MASS; QUANTIFIES
DISEASE_DISORDER MASS: HAS_MASS
SIGN_SYMPTOM MASS: HAS_MASS
BIOLOGICAL_STRUCTURE VOLUME: HAS_VOLUME; QUANTIFIES
DISEASE_DISORDER VOLUME: HAS_VOLUME
SIGN_SYMPTOM VOLUME: HAS_VOLUME
AREA VOLUME: HAS_VOLUME
DURATION SIGN_SYMPTOM: DURATION_OF
DURATION DISEASE_DISORDER: DURATION_OF
DURATION THERAPEUTIC_PROCEDURE: DURATION_OF
DURATION MEDICATION: DURATION_OF
DATE SIGN_SYMPTOM: DURATION_OF
DATE DISEASE_DISORDER: DURATION_OF
DATE THERAPEUTIC_PROCEDURE: DURATION_OF
TIME SIGN_SYMPTOM: DURATION_OF
TIME DISEASE_DISORDER: DURATION_OF
DISEASE_DISORDER DURATION: DURATION_OF
SIGN_SYMPTOM DURATION: DURATION_OF
DISEASE_DISORDER DATE: DURATION_OF
SIGN_SYMPTOM DATE: DURATION_OF
AGE DISEASE_DISORDER: RISK_FACTOR_OF
FAMILY_HISTORY DISEASE_DISORDER: RISK_FACTOR_OF; INDICATES
HISTORY DISEASE_DISORDER: RISK_FACTOR_OF; ASSOCIATED_WITH
OUTCOME DISEASE_DISORDER: INDICATES
OUTCOME THERAPEUTIC_PROCEDURE: INDICATES
OUTCOME MEDICATION: INDICATES
QUALITATIVE_CONCEPT SIGN_SYMPTOM: INDICATES
QUALITATIVE_CONCEPT DISEASE_DISORDER: INDICATES
CLINICAL_EVENT DATE: OCCURS_AT
CLINICAL_EVENT TIME: OCCURS_AT
CLINICAL_EVENT DURATION: HAS_DURATION
CLINICAL_EVENT OUTCOME: LEADS_TO
CLINICAL_EVENT NONBIOLOGICAL_LOCATION: PERFORMED_IN
HISTORY CLINICAL_EVENT: PREVIOUSLY_OCCURRED
DETAILED_DESCRIPTION CLINICAL_EVENT: DESCRIBES
ACTIVITY CLINICAL_EVENT: RELATED_TO
DETAILED_DESCRIPTION DISEASE_DISORDER: DESCRIBES
DETAILED_DESCRIPTION SIGN_SYMPTOM: DESCRIBES
DETAILED_DESCRIPTION BIOLOGICAL_STRUCTURE: DESCRIBES
DETAILED_DESCRIPTION THERAPEUTIC_PROCEDURE: DESCRIBES
DETAILED_DESCRIPTION DIAGNOSTIC_PROCEDURE: DESCRIBES
SUBJECT AGE: HAS_AGE
SUBJECT SEX: HAS_SEX
SUBJECT WEIGHT: HAS_WEIGHT
SUBJECT HEIGHT: HAS_HEIGHT
SUBJECT OCCUPATION: HAS_OCCUPATION
SUBJECT PERSONAL_BACKGROUND: HAS_PERSONAL_BACKGROUND
SUBJECT FAMILY_HISTORY: HAS_FAMILY_HISTORY
SUBJECT DISEASE_DISORDER: HISTORY_OF
"""

#: Each relation's role in the fact graph; then its canonical relation, `inverse`, or its field.
ROLE_TEXT = """
CAUSES: clinical
TREATS: clinical
DIAGNOSES: clinical
REVEALS: clinical
INDICATES: clinical
ASSOCIATED_WITH: clinical
HAS_SYMPTOM: clinical
RESULTS_IN: clinical
PERFORMED_IN: clinical
MEASURES: clinical
GIVEN_FOR: clinical; canonical=TREATS
LEADS_TO: clinical; canonical=RESULTS_IN
IS_VALUE_OF: clinical; canonical=MEASURES
LOCATED_IN: clinical
PERFORMED_ON: clinical
AFFECTS: clinical
CONTAINS: clinical; canonical=LOCATED_IN; inverse
HAS_SEVERITY: attribute; field=severity
HAS_DOSAGE: attribute; field=dosage
HAS_FREQUENCY: attribute; field=frequency
HAS_ADMINISTRATION: attribute; field=route
HAS_COLOR: attribute; field=color
HAS_SHAPE: attribute; field=shape
HAS_TEXTURE: attribute; field=texture
HAS_MASS: attribute; field=value
HAS_VOLUME: attribute; field=value
DURATION_OF: attribute; field=duration
HAS_DURATION: attribute; field=duration
OCCURS_AT: attribute; field=onset
DESCRIBES: attribute; field=descriptor
ADMINISTERED_AS: attribute; field=dosage
QUANTIFIES: attribute; field=value
HAS_AGE: demographic
HAS_SEX: demographic
HAS_WEIGHT: demographic
HAS_HEIGHT: demographic
HAS_OCCUPATION: demographic
HAS_PERSONAL_BACKGROUND: demographic
HISTORY_OF: dissolved
PREVIOUSLY_OCCURRED: dissolved
RISK_FACTOR_OF: dissolved
RELATED_TO: dissolved
"""

RESOURCE_TEXT = """
DISEASE_DISORDER: Condition
SIGN_SYMPTOM: Condition
MEDICATION: MedicationStatement
THERAPEUTIC_PROCEDURE: Procedure
DIAGNOSTIC_PROCEDURE: Procedure
LAB_VALUE: Observation
OUTCOME: Observation
ACTIVITY: Observation
CLINICAL_EVENT: Encounter
BIOLOGICAL_STRUCTURE: BodyStructure
AREA: BodyStructure
NONBIOLOGICAL_LOCATION: Location
"""

#: Demographic labels: properties of a patient, never facts.
DEMOGRAPHIC_LABELS = ("AGE", "HEIGHT", "OCCUPATION", "PERSONAL_BACKGROUND", "SEX", "WEIGHT")

#: Relations whose subject belongs on one side: (relation, resources of its subject).
DIRECTION_TEXT = """
TREATS: Procedure; MedicationStatement
DIAGNOSES: Procedure
MEASURES: Procedure
"""

#: Labels under other names in the concept graph.
NODE_LABEL_TEXT = """
BIOLOGICAL_STRUCTURE: BiologicalStructure
DISEASE_DISORDER: DiseaseDisorder
SIGN_SYMPTOM: SignSymptom
DETAILED_DESCRIPTION: DetailedDescription
MEDICAL_DEVICE: MedicalDevice
MEDICATION: Medication
PROCEDURE: Procedure
LAB_VALUE: LabValue
"""

#: Terms of relatives; the first one that a text contains counts.
RELATIVES = "grandmother grandfather grandparent mother father parent sister brother sibling son daughter aunt uncle cousin".split()

#: Assertion flags and their statuses, in order of precedence.
ASSERTION_FLAGS = (("is_negated", "negated"), ("is_uncertain", "uncertain"), ("is_family", "family"), ("is_historical", "historical"))

#: Cues that negate what stands before them, and what ends the reach of any cue.
BACKWARD_NEGATION = "were not found; not found; not seen; not visualized; not visualised; not identified; not detected; not observed; not demonstrated; not appreciated".split("; ")
TERMINATORS = "; , but however except otherwise whereas".split()
ASSERTION_SCOPE = 5

#: Dependency labels of subjects, objects, modifiers and predicates, and the relations read off attachments alone.
SUBJECT_DEPS, OBJECT_DEPS = ("nsubj", "nsubjpass"), ("dobj", "attr", "pobj", "oprd")
MODIFIER_DEPS, PREDICATE_DEPS = ("amod", "compound"), ("acomp", "attr", "oprd")
ATTACHMENT_RELATIONS = ("DESCRIBES", "HAS_SEVERITY", "HAS_COLOR", "HAS_SHAPE", "HAS_TEXTURE")

#: Methods in order of priority.
MENTION_PRIORITY = ("llm", "gazetteer", "neural")
RELATION_PRIORITY = ("spacy_lexical", "spacy_dependency", "biolink_bert", "llm")

#: Thresholds: of mentions, of embedding relations, of generated relations, of concept links, of graph edges.
MENTION_THRESHOLD, EMBEDDING_THRESHOLD, GENERATED_THRESHOLD, LINK_THRESHOLD, EDGE_THRESHOLD = 0.40, 0.70, 0.1, 0.70, 0.5

#: Fields with a number in them, and those of them that have a unit.
NUMERIC_FIELDS = ("age", "dosage", "duration", "height", "value", "weight")
UNIT_FIELDS = ("dosage", "duration", "height", "value", "weight")

#: Batch sizes of generative extractors: records, sentences, records of the joint extractor; tries after a failed call.
MENTION_BATCH, RELATION_BATCH, JOINT_BATCH, RETRIES = 10, 5, 10, 2

# ---- end of the fixed values ----


def _table(text: str) -> dict[str, list[str]]:
    rows = (line.partition(": ") for line in text.strip().splitlines())
    return {name: body.split("; ") for name, _, body in rows}


LEXICONS = _table(LEXICON_TEXT)
PATTERNS = {k: v for k, _, v in (line.partition(": ") for line in PATTERN_TEXT.strip().splitlines())}
FORWARD, INVERTED = _table(FORWARD_TEXT), _table(INVERTED_TEXT)
VERBS = {lemma: relation for relation, lemmas in _table(VERB_TEXT).items() for lemma in lemmas}
PROTOTYPES = {k: v for k, _, v in (line.partition(": ") for line in PROTOTYPE_TEXT.strip().splitlines())}
LICENCES = {tuple(k.split(" ")): v for k, v in _table(LICENCE_TEXT).items()}
RESOURCES = {k: v[0] for k, v in _table(RESOURCE_TEXT).items()}
NODE_LABELS = {k: v[0] for k, v in _table(NODE_LABEL_TEXT).items()}
DIRECTIONS = _table(DIRECTION_TEXT)


def _role(parts: list[str]) -> dict[str, object]:
    named = dict(p.split("=") for p in parts[1:] if "=" in p)
    return {"role": parts[0], "canonical": named.get("canonical"), "inverse": "inverse" in parts, "field": named.get("field")}


ROLES = {k: _role(v) for k, v in _table(ROLE_TEXT).items()}
ATTRIBUTE_FIELDS = sorted({r["field"] for r in ROLES.values() if r["role"] == "attribute"})


def terms(spark: SparkSession, lexicons: dict[str, list[str]] = LEXICONS) -> DataFrame:
    """label, term, ord: the lexicon in order."""
    rows = [(label, term) for label, own in lexicons.items() for term in own]
    return spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(rows)], "label string, term string, ord int")


def triggers(spark: SparkSession, forward: dict[str, list[str]] = FORWARD, inverted: dict[str, list[str]] = INVERTED) -> DataFrame:
    """relation, trigger, direction (F or I), ord."""
    rows = [(r, t, d) for d, own in (("F", forward), ("I", inverted)) for r, ts in own.items() for t in ts]
    return spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "relation string, trigger string, direction string, ord int")


def licences(spark: SparkSession, pairs: dict[tuple[str, str], list[str]] = LICENCES) -> DataFrame:
    """label1, label2, relation, ord (within the pair)."""
    rows = [(a, b, r, k) for (a, b), rs in pairs.items() for k, r in enumerate(rs)]
    return spark.createDataFrame(rows, "label1 string, label2 string, relation string, ord int")


def roles(spark: SparkSession) -> DataFrame:
    """relation, role, canonical, inverse, field."""
    rows = [(k, r["role"], r["canonical"], r["inverse"], r["field"]) for k, r in ROLES.items()]
    return spark.createDataFrame(rows, "relation string, role string, canonical string, inverse boolean, field string")


def verbs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VERBS.items()), "lemma string, relation string")


def labels(spark: SparkSession, names: list[str] = ENTITY_LABELS) -> DataFrame:
    return spark.createDataFrame([(x, k) for k, x in enumerate(names)], "label string, ord int")
