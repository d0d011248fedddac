"""Fixed values that must equal the reference behaviour.

Everything in this module is data, stated plainly and in natural order so
results line up with the original tool: term synonyms, lexicon categories,
keyword lists, measurement names and standardisation maps. The operators take
any of these as parameters, so callers can pass their own tables instead.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: symptom synonym map (raw lowercase term -> canonical term).
# Lookup is one hop; keys holding '_' can never match because cleaning turns
# '_' into a space first.
# ---------------------------------------------------------------------------
SYMPTOM_SYNONYMS: dict[str, str] = {
    "belly pain": "abdominal pain",
    "stomach pain": "abdominal pain",
    "swelling of stomach": "distention of abdomen",
    "stomach ache": "stomach pain",
    "tummy ache": "stomach pain",
    "burning micturition": "painful urination",
    "irritation in anus": "anal discomfort",
    "pain in anal region": "anal discomfort",
    "body ache": "muscle pain",
    "body pain": "muscle pain",
    "body aches": "muscle pain",
    "lethargy": "fatigue",
    "malaise": "fatigue",
    "spinning movements": "dizziness",
    "loss of balance": "unsteadiness",
    "palpitation": "fast heart rate",
    "perspiration": "sweating",
    "chill": "chills",
    "vomit": "vomiting",
    "nausea": "vomiting",
    "fever": "high fever",
    "pyrexia": "high fever",
    "itch": "itching",
    "internal itching": "itching",
    "swollen extremeties": "swollen extremities",
    "swollen legs": "swollen extremities",
    "excessive hunger": "increased appetite",
    "weakness in limbs": "muscle weakness",
    "running nose": "runny nose",
    "runny nose": "runny nose",
    "runny noses": "runny nose",
    "runny_nose": "runny nose",
    "yellow urine": "yellow urine",
    "yellow pee": "yellow urine",
    "yellow pee.": "yellow urine",
    "yellow pee?": "yellow urine",
    "yellow pee!": "yellow urine",
    "yellow pee ": "yellow urine",
    "yellow peeing": "yellow urine",
    "loose motion": "diarrhoea",
    "loose motions": "diarrhoea",
    "loose stool": "diarrhoea",
    "loose stools": "diarrhoea",
    "loose stooling": "diarrhoea",
    "sore throat": "throat irritation",
    "throat pain": "throat irritation",
    "cold hands and feets": "cold hands and feet",
    "dischromic  patches": "dischromic patches",
    "scurring": "skin scaling",
    "spotting  urination": "spotting during urination",
    "toxic look (typhos)": "toxic look (typhus)",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: symptom lexicon, category -> terms (whole-word, lowercase).
# ---------------------------------------------------------------------------
SYMPTOM_CATEGORIES: dict[str, list[str]] = {
    "respiratory": [
        "cough", "coughing", "shortness of breath", "breathing difficulty",
        "wheezing", "chest pain", "sore throat", "throat pain",
        "runny nose", "nasal congestion", "stuffy nose", "sneezing",
    ],
    "systemic": [
        "fever", "temperature", "hot", "chills", "fatigue", "tired",
        "exhausted", "weakness", "malaise", "sweating",
    ],
    "neurological": [
        "headache", "head pain", "dizziness", "confusion",
        "memory loss", "numbness", "tingling",
    ],
    "gastrointestinal": [
        "nausea", "vomiting", "sick", "diarrhea", "constipation",
        "stomach pain", "abdominal pain", "heartburn", "bloating",
    ],
    "musculoskeletal": [
        "joint pain", "muscle pain", "back pain", "stiffness",
        "swelling", "inflammation",
    ],
    "dermatological": [
        "rash", "skin irritation", "itching", "redness",
        "swelling", "bruising", "lesions",
    ],
    "cardiovascular": [
        "chest pain", "palpitations", "rapid heartbeat",
        "irregular heartbeat", "high blood pressure",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: tumour characteristic lexicon, category -> terms.
# ---------------------------------------------------------------------------
CHARACTERISTIC_CATEGORIES: dict[str, list[str]] = {
    "malignancy": [
        "malignant", "benign", "cancerous", "non-cancerous",
        "tumor", "mass", "lesion", "growth",
    ],
    "texture_characteristics": [
        "smooth", "rough", "irregular", "uniform", "heterogeneous",
        "homogeneous", "coarse", "fine", "grainy",
    ],
    "density_characteristics": [
        "dense", "solid", "cystic", "fluid-filled",
        "calcified", "soft tissue", "fibrous",
    ],
    "border_characteristics": [
        "well-defined", "ill-defined", "circumscribed",
        "infiltrating", "spiculated", "lobulated",
    ],
    "imaging_characteristics": [
        "hypoechoic", "hyperechoic", "isoechoic",
        "radiolucent", "radiopaque", "enhancement",
    ],
}

# FIXED VALUES: characteristic synonyms (applied after extraction, distinct).
CHARACTERISTIC_SYNONYMS: dict[str, str] = {
    "cancerous": "malignant",
    "non-cancerous": "benign",
    "tumor": "mass",
    "lesion": "mass",
    "growth": "mass",
    "coarse": "rough",
    "fine": "smooth",
    "fluid-filled": "cystic",
    "well-defined": "circumscribed",
    "ill-defined": "irregular",
}

# FIXED VALUES: measurement key standardisation; 'diameter' is also halved.
MEASUREMENT_KEY_MAP: dict[str, str] = {
    "diameter": "radius",
    "size": "radius",
    "circumference": "perimeter",
    "fractal": "fractal_dimension",
}

# FIXED VALUES: measurement names the rule extractor knows, in pattern order
# (on a clash after standardisation, the later name wins).
MEASUREMENT_NAMES: list[str] = [
    "radius", "texture", "perimeter", "area", "smoothness", "compactness",
    "concavity", "concave_points", "symmetry", "fractal_dimension",
    "diameter", "size",
]
MEASUREMENT_SUFFIXES: list[str] = ["mean", "se", "worst"]

# FIXED VALUES: substrings that route a message to the disease tool.
DISEASE_INDICATORS: list[str] = [
    "symptom", "symptoms", "feel", "feeling", "pain", "ache",
    "sick", "ill", "disease", "condition", "have", "experiencing",
]

# FIXED VALUES: substrings that route a message to the tumour tool.
CANCER_KEYWORDS: list[str] = [
    "tumor", "mass", "lump", "breast", "cancer", "oncology",
    "malignant", "benign", "biopsy", "mammogram", "ultrasound",
    "radius", "perimeter", "area", "smoothness", "compactness",
    "concavity", "symmetry", "fractal", "texture",
]
# FIXED VALUES: a number with a unit also routes to the tumour tool.
MEASUREMENT_UNIT_PATTERN = r"\d+\.?\d*\s*(?:mm|cm|units?)"

# FIXED VALUES: follow-up threshold of the chat session.
MIN_ITEMS_FOR_CONFIDENCE = 5


def lexicon_rows(categories: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(category, term) rows in declaration order."""
    return [(cat, term) for cat, terms in categories.items() for term in terms]

# ---------------------------------------------------------------------------
# FIXED VALUES: feature-name aliases applied after feature-name normalisation.
# ---------------------------------------------------------------------------
FEATURE_ALIASES: dict[str, str] = {
    "running_nose": "runny_nose",
    "runny_nose": "runny_nose",
    "runny_noses": "runny_nose",
    "runningnose": "runny_nose",
    "coughing": "cough",
    "yellow_pee": "yellow_urine",
    "yellowpee": "yellow_urine",
    "yellow_peeing": "yellow_urine",
    "yellow_peepee": "yellow_urine",
    "high_temperature": "high_fever",
    "high_temp": "high_fever",
    "feverish": "high_fever",
    "pyrexia": "high_fever",
    "body_ache": "muscle_pain",
    "body_pain": "muscle_pain",
    "body_pains": "muscle_pain",
    "loose_motion": "diarrhoea",
    "loose_motions": "diarrhoea",
    "loose_stools": "diarrhoea",
    "loose_stool": "diarrhoea",
    "stomach_ache": "stomach_pain",
    "tummy_ache": "stomach_pain",
    "sore_throat": "throat_irritation",
    "throat_pain": "throat_irritation",
}
