"""Tables, word lists and patterns that results depend on. They are data, given by the record format, not logic."""

# fixed values: texts that stand for no value
NULL_TOKENS = ["", "-", "—", "na", "n/a", "nr", "not reported", "not available", "none", "null"]

# fixed values: the pattern of a number
NUMBER = r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?"

# fixed values: sections left out unless a field says otherwise
SECTION_EXCLUDES = ["references", "acknowledgements", "acknowledgments", "conflict of interest", "conflicts of interest", "funding", "author contributions"]

# fixed values: weights of matches
PATTERN_WEIGHTS = {"strong": 3.0, "medium": 1.5, "other": 1.0}
CAPTION_WEIGHT, HEADER_WEIGHT = 2.0, 1.5
RRF_K = 60

# fixed values: spellings of units
CANONICAL_UNITS = {
    "%": "percent", "percentage": "percent",
    "ug/ml": "ug/mL", "µg/ml": "ug/mL", "μg/ml": "ug/mL", "ng/ml": "ng/mL", "mg/ml": "mg/mL",
    "mg/kg/day": "mg/kg/day", "mg/m2": "mg/m2", "mg/m^2": "mg/m2", "mg/m²": "mg/m2",
    "ug/kg": "ug/kg", "µg/kg": "ug/kg", "μg/kg": "ug/kg",
    "months": "month", "mo": "month", "mos": "month", "years": "year", "yr": "year", "yrs": "year",
    "weeks": "week", "wks": "week", "days": "day", "hours": "h", "hrs": "h",
    "minute": "min", "minutes": "min", "mins": "min",
    "μm": "um", "µm": "um", "micrometer": "um", "micrometers": "um", "micron": "um", "microns": "um",
    "celsius": "C", "°c": "C", "hazard ratio": "ratio",
}

# fixed values: (pattern, unit) in the order in which they are tried; None: the match itself in its usual spelling
UNIT_LADDER = [
    (r"(?i)\bhazard\s+ratio\b|(?-i)\bHR\b", "ratio"),
    (r"\b(?:nM|uM|µM|μM|mM)\b", None),
    (r"(?i)\b(?:ng|ug|µg|μg|mg|g)\s*/\s*m(?:\^?2|²)\b", None),
    (r"\b(?:ng|ug|µg|μg|mg)/m[lL]\b", None),
    (r"(?i)\b(?:mg|ug|µg|μg)/kg(?:/day)?\b", None),
    (r"(?i)\bml/min/kg\b", "mL/min/kg"),
    (r"(?i)%|\bpercent(?:age)?\b", "percent"),
    (r"(?i)\bmonths?\b|\bmos?\b", "month"),
    (r"(?i)\byears?\b|\byrs?\b", "year"),
    (r"(?i)\bweeks?\b|\bwks?\b", "week"),
    (r"(?i)\bdays?\b", "day"),
    (r"(?i)\bhours?\b|\bhrs?\b|\bh\b", "h"),
    (r"(?i)\bmin(?:utes?|s)?\b", "min"),
    (r"(?i)\bgpa\b", "GPa"),
    (r"(?i)\bmpa\b", "MPa"),
    (r"(?i)\bnm\b", "nm"),
    (r"(?i)\b(?:mm|millimeters?)\b", "mm"),
    (r"(?i)\b(?:um|μm|µm|micrometers?|microns?)\b", "um"),
    (r"(?i)°\s*c\b|\bcelsius\b|\bdeg(?:ree)?\s*c\b|\b\d+\s*c\b", "C"),
]

# fixed values: factors between units
UNIT_FACTORS = {("GPa", "MPa"): 1000.0, ("MPa", "GPa"): 0.001, ("year", "month"): 12.0, ("month", "year"): 1 / 12.0, ("nm", "um"): 0.001, ("mm", "um"): 1000.0, ("um", "nm"): 1000.0}

# fixed values: what numeric evidence looks like
ENDPOINT_TERMS = (
    r"\b(?:IC\s*50|IC50|IC\s*90|IC90|GI\s*50|GI50|EC\s*50|EC50|Cmax|Tmax|AUC|half[-\s]?life|clearance|tumou?r\s+(?:volume|weight|growth)|growth inhibition|TGI|"
    r"cell viability|cell proliferation|cytotoxicity|colony formation|migration|invasion|apoptosis|overall survival|progression[-\s]?free survival|OS|PFS|ORR|DCR)\b"
)
VALUE_WITH_UNIT = (
    r"(?:[<>~=≈≤≥]?\s*)?\d[\d,]*(?:\.\d+)?(?:\s*(?:-|–|to)\s*\d[\d,]*(?:\.\d+)?)?(?:\s*(?:±|\+/-)\s*\d[\d,]*(?:\.\d+)?)?\s*"
    r"(?:%|nM|pM|uM|µM|μM|mM|mg/kg|mg|g|mm3|mm³|cm3|cm³|%\s*ID/g|%ID/g|% ID|months?|days?|hours?|h|ng/mL|µg/g|μg/g|µg/mL|μg/mL|kBq(?:/mL)?)"
)
RESULT_SECTIONS, OTHER_SECTIONS = "result", ["method", "materials", "introduction", "discussion"]
POTENCY_TERMS = r"\b(?:IC|GI|EC)\s*(?:50|90)\b"
CUE_WORDS = r"\b(?:significant|significantly|increased|decreased|reduced|inhibited|compared)\b"

# fixed values: weights of fields when a record is traced to its chunks, words that say nothing there, texts that are no value
SOURCE_WEIGHTS = {
    "value": 8.0, "statistics": 4.0, "endpoint": 3.0, "compound_or_treatment": 3.0, "comparator_or_control": 2.5, "dose": 2.5, "duration": 2.5,
    "model_or_population": 2.0, "assay_or_study_type": 1.5, "sample_size": 1.5, "unit": 1.0, "route": 1.0,
}
WORD_WEIGHT = 0.25
STOP_WORDS = [
    "and", "the", "with", "without", "group", "groups", "patient", "patients", "cell", "cells", "mouse", "mice", "model", "models", "study", "therapy", "treatment", "cancer", "pdac", "pancreatic",
]
NO_VALUE = ["none", "null", "not stated", "not reported"]

# fixed values: limits
CONTEXT_CHARS, NUMERIC_CHUNKS, SOURCE_CHUNKS = 12_000, 8, 4
SPLIT_TOKENS, TAIL_TOKENS = 400, 200
