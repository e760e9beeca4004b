"""Word lists, weights and thresholds that classification results depend on.

They stand here as plain tables in their natural order; where a rule takes the
first of several groups that matches, the order of the groups is part of the rule.
"""

# --- sentence classification: first group wins, phrases between word boundaries
METHOD_TAGS = {
    "lc-ms/ms": ["lc-ms/ms", "lc ms/ms", "lc-ms", "mass spectrometry", "ms/ms", "mass spec"],
    "mass_spec": ["mass spectrometry", "mass spec", "ms", "ms/ms"],
    "fluorescent": ["fluorescent", "fluorescence", "fluorophore", "label"],
    "serum": ["serum", "plasma", "biological fluids"],
    "incubation": ["incubation", "long incubation"],
    "nitrosamine": ["nitrosamine", "nitrosamines"],
    "gmp": ["gmp", "good manufacturing practice"],
}
FAILURE_PHRASES = {
    "stability_failure": ["rapidly degraded", "degraded", "unstable", "poor stability", "short half-life"],
    "no_activity": ["no significant", "no measurable", "did not show", "no activity", "inactive"],
    "toxicity_flag": ["cytotoxic", "toxicity", "cell death", "toxic"],
    "reproducibility": ["not reproducible", "poor reproducibility", "lack of reproducibility", "irreproducible", "failed reproducibility"],
    "scalability": ["scale-up", "scalable", "manufacturing", "yield", "process", "costly to produce"],
    "regulatory": ["regulatory", "guideline", "compliance", "safety concern", "risk assessment"],
}
DECISION_PHRASES = {
    "abandoned": ["not pursued", "not pursued further", "excluded", "discarded", "abandoned", "dropped"],
    "modified": ["optimized", "modified", "analog", "derivative", "cyclized", "pegylated", "amidated", "redesigned"],
    "continued": ["further study", "continued", "follow-up", "subsequently", "next we", "we decided", "decided to", "chose to"],
    "paused": ["inconclusive", "unclear", "requires further investigation", "pending"],
    "replicated": ["replicated", "repeated", "validated", "confirmed"],
    "escalated": ["advanced to", "moved to", "progressed to"],
}
OUTCOME_PHRASES = {
    "negative": ["no significant", "no measurable", "inactive", "excluded", "not pursued", "did not", "failed to", "no improvement", "worsened", "decreased", "declined", "degradation", "toxic", "toxicity", "adverse"],
    "positive": ["improved", "increased", "enhanced", "more stable", "longer half-life", "better", "higher", "greater", "successful", "showed activity", "demonstrated", "significant"],
    "neutral": ["moderate", "marginal", "partial", "mixed", "limited", "trend"],
}
HIGH_SIGNAL_TERMS = ["lc-ms", "mass spectrometry", "in vivo", "in vitro", "clinical", "ic50", "ec50", "half-life", "degraded", "stable", "toxic", "efficacy", "optimized", "modified", "abandoned", "continued"]
TOXICITY_WORDS = ["toxic", "toxicity", "cytotoxic"]
DEGRADATION_WORDS = ["degradation", "degraded", "corrosion", "instability", "unstable", "poor stability"]
ACTIVITY_WORDS = ["activity", "efficacy", "potent", "ic50", "ec50"]
PRODUCTION_WORDS = ["manufacturing", "scale-up", "yield", "production"]
COST_WORDS = ["cost-intensive", "expensive", "time-consuming", "efficient", "cost-effective"]
STRONG_EVIDENCE = ["we conclude", "demonstrate", "significant", "robust", "strong"]
WEAK_EVIDENCE = ["suggest", "may", "might", "could", "trend"]
HIGH_CONFIDENCE, MED_CONFIDENCE = 6, 3
STAGES = {
    "clinical": ["clinical", "patients", "phase i", "phase ii", "randomized"],
    "in_vivo": ["in vivo", "mouse", "rat", "animal model"],
    "in_vitro": ["in vitro", "cell line", "cell culture", "primary cells", "cell assay"],
}
#: Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ["Dr.", "Mr.", "Mrs.", "Ms.", "Prof.", "et al.", "i.e.", "e.g.", "Fig.", "vs."]

# --- measurements: name, pattern of the quantity, units
MEASUREMENTS = [
    ("ic50", "ic50", "nm|[µμ]m|mm"),
    ("ec50", "ec50", "nm|[µμ]m|mm"),
    ("kd", "kd", "nm|[µμ]m|mm"),
    ("ki", "ki", "nm|[µμ]m|mm"),
    ("half_life", "half[- ]?life", "min|hour|day|hr|h"),
    ("stability_percent", "stability", "%|percent"),
    ("half_life", "t1/2", "min|hour|day|hr|h"),
]
RELATIONS = [
    ("more_stable_than", r"(?:was|is|showed)\s+more\s+stable\s+than"),
    ("more_potent_than", r"(?:was|is|showed)\s+more\s+potent\s+than"),
    ("less_toxic_than", r"(?:was|is)\s+less\s+toxic\s+than"),
    ("analog_of", r"(?:is|was)\s+(?:a|an)\s+analog\s+of"),
    ("derivative_of", r"(?:is|was)\s+(?:a|an)\s+derivative\s+of"),
]

# --- entities by keyword
STEM_CELL_KEYWORDS = ["msc", "mesenchymal", "ipsc", "pluripotent", "stem cell", "stem-cell", "differentiation", "reprogramming"]
NEURAL_CELL_KEYWORDS = ["neuron", "neurons", "dopaminergic", "glutamatergic", "gabaergic", "astrocyte", "astrocytes", "oligodendrocyte", "oligodendrocytes", "microglia", "microglial"]
FALLBACK_MODELS = ["mouse", "rat", "human", "hela", "hek293"]
KNOWN_PEPTIDES = ["ETELCALCETIDE", "PLECANATIDE", "TERIPARATIDE", "OCTREOTIDE", "LANREOTIDE", "PASIREOTIDE", "SOMATOSTATIN"]
PEPTIDE_DENYLIST = ["CANADIAN", "CLIMATE", "PREFACE", "PRINCIPAL", "SERVICE", "PACIFIC"]
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
TARGET_CONTEXT_TERMS = ["protein", "gene", "receptor", "kinase", "phosphorylation", "expression", "signaling", "pathway", "assay", "cell", "cells", "compound", "treatment", "inhibitor", "inhibition", "mutation", "disease", "binding"]
#: Construction entities; groups in the order in which they claim a name.
CONSTRUCTION_GROUPS = {
    "material": ["concrete", "steel", "wood", "glass", "brick", "timber", "mortar", "insulation", "polymer", "composite", "asphalt", "aluminum", "copper", "gypsum", "plaster", "ceramic", "stone", "aggregate", "fiber", "foam", "bitumen", "pvc", "eps", "xps", "hdpe", "ldpe"],
    "system": ["wall", "roof", "foundation", "floor", "column", "beam", "slab", "girder", "truss", "panel", "joint", "window", "door", "façade", "cladding", "insulation system", "partition", "rafter", "stud", "joist", "lintel"],
    "failure_mode": ["crack", "cracking", "shear failure", "buckling", "fatigue", "delamination", "fracture", "rupture", "collapse", "spalling", "yielding", "debonding", "creep", "shrinkage", "corrosion fatigue", "brittle fracture", "ductile fracture", "plastic hinge", "instability", "microcrack", "macrocrack"],
    "environment": ["temperature", "thermal cycling", "humidity", "moisture", "wind", "rain", "fire", "freeze", "frost", "uv", "solar", "environmental stress", "exposure", "condensation", "weather", "climate", "precipitation", "snow", "hail", "thermal shock"],
    "test_method": ["compression", "tension", "shear", "bending", "torsion", "impact", "flexure", "creep test", "fatigue test", "tensile test", "load test", "stress test", "thermal analysis", "modulus", "stiffness", "ductility", "hardness", "strength", "yield strength", "ultimate strength", "elasticity", "plasticity"],
    "hazard": ["flood", "seismic", "earthquake", "corrosion", "erosion", "vibration", "overload", "fire hazard", "chemical attack", "abrasion", "freeze-thaw", "alkali-silica reaction", "subsidence", "settlement", "liquefaction", "tsunami", "landslide", "storm", "hurricane", "typhoon", "cyclone"],
}
FAILURE_KINDS = ["failure", "crack", "fracture", "collapse"]
FAILURE_CAUSES = ["shear", "fatigue", "stress", "thermal", "brittle", "ductile", "creep", "shrinkage", "corrosion"]

# --- lenses
UNIT_PATTERNS = [
    r"\bmpa\b", r"\bkpa\b", r"\bgpa\b", r"\bkn\b", r"\bmn\b", r"\bmm\b", r"\bcm\b", r"\bft\b", r"\bw/m2k\b", r"\bw/m·k\b", r"\bw/mk\b",
    r"\bwh\b", r"\bkwh\b", r"\bkw\b", r"\bpa\b", r"\bppm\b", r"(?<=\d)%(?=\s|$)", r"\bpercent\b", r"\b°c\b", r"\bdegc\b", r"\b°f\b",
]
#: Of each unit pattern a part that a text with the unit has.
UNIT_PARTS = ["pa", "kn", "mn", "mm", "cm", "ft", "w/m", "wh", "kw", "ppm", "%", "percent", "°c", "degc", "°f"]
OUTCOME_BUCKETS = {"improved": "positive", "successful": "positive", "pass": "positive", "positive": "positive", "degraded": "negative", "failed": "negative", "fail": "negative", "negative": "negative", "neutral": "neutral", "mixed": "neutral", "mixed_hazard": "neutral", "stable": "neutral", "unknown": "unknown"}
SOURCE_WEIGHTS = {"reddit": 0.25, "forum": 0.35, "social_post": 0.35, "blog": 0.55, "news": 0.65, "industry_article": 0.75, "technical_report": 0.85, "research_paper": 0.9, "standard": 1.0, "code_standard": 1.0}
STRONG_RESULT_TERMS = ["improved", "enhanced", "higher", "reduced", "lower", "decreased", "failed", "collapse", "non-compliant", "complies", "meets", "worsened", "exacerbated"]
MODERATE_CONTEXT_TERMS = ["measured", "tested", "evaluated", "simulated", "modeled", "validated", "due to", "caused by", "resulted from", "requirements", "standard", "specimens"]
GENERIC_NAMES = ["indirect", "direct", "positive", "negative", "control", "test", "sample", "result", "data", "method", "analysis", "study", "research", "paper", "article", "report"]
LENS = {
    "assemblies": ["envelope", "wall", "roof", "attic", "basement", "slab", "window", "glazing", "facade", "cladding", "insulation", "air barrier", "vapor barrier", "duct", "hvac"],
    "physics": ["u-value", "u value", "r-value", "r value", "thermal conductivity", "heat flux", "air leakage", "infiltration", "ventilation rate", "ach", "air changes per hour", "relative humidity", "dew point", "condensation", "moisture", "mold", "energy use", "energy consumption", "cooling load", "heating load", "indoor temperature", "comfort"],
    "physics_good": ["reduced energy", "reduced consumption", "lower u-value", "lower u value", "improved insulation", "improved airtightness", "decreased heat loss", "better insulation", "better airtightness", "reduced heat transfer", "lower heat loss", "lower energy use", "lower energy consumption", "improved r-value", "improved r value", "reduced infiltration"],
    "physics_bad": ["higher energy", "increased leakage", "worsened", "condensation risk", "mold growth", "mold detected"],
    "measured": ["measured", "simulated", "modeled", "validated"],
    "hazards": ["flood", "storm surge", "sea-level rise", "sea level rise", "wind", "hurricane", "tornado", "wildfire", "smoke", "heat wave", "extreme heat", "high temperature", "freeze-thaw", "freeze thaw", "icing", "humidity", "moisture", "drought"],
    "resilience": ["resilience", "adaptation", "mitigation", "risk", "hazard", "exposure", "vulnerability"],
    "climate_materials": ["concrete", "steel", "wood", "timber", "brick", "masonry", "glass", "aluminum", "copper", "plastic", "composite", "polymer", "insulation", "foam", "panel", "board", "membrane", "coating", "paint", "sealant"],
    "climate_systems": ["roof", "wall", "floor", "foundation", "structure", "frame", "beam", "column", "slab", "deck", "façade", "cladding", "curtain wall", "window", "door", "ventilation", "HVAC", "heating", "cooling", "drainage", "plumbing", "electrical", "mechanical", "structural system", "building envelope"],
    "climate_bad": ["increased risk", "risk increased", "worsened", "exacerbated", "higher vulnerability"],
    "climate_good": ["reduced", "mitigated", "improved", "enhanced"],
    "scenarios": ["scenario", "projection", "return period", "rcp", "ssp"],
    "standards": ["astm", "aci", "asce", "ibc", "iecc", "ashrae", "iso", "eurocode"],
    "passes": ["meets", "complies", "complied with", "in accordance with", "conforms", "satisfies"],
    "fails": ["non-compliant", "noncompliant", "does not meet", "did not comply", "fails to meet", "violation", "does not comply", "doesn't comply", "doesn't meet"],
    "failure_modes": ["cracking", "spalling", "buckling", "fatigue", "corrosion", "delamination", "creep", "shrinkage", "settlement", "leakage", "mold", "fracture", "collapse"],
    "failure_drivers": ["overload", "poor detailing", "water intrusion", "freeze-thaw", "thermal cycling", "chloride ingress", "carbonation", "humidity", "improper curing", "design error", "construction defect", "material defect", "foundation movement", "wind load", "seismic"],
    "causes": ["due to", "caused by", "attributed to", "resulted from", "led to", "because of"],
    "failure_signals": ["failure", "failed", "collapse", "fracture", "investigation", "forensic", "root cause"],
    "materials": ["concrete", "reinforced concrete", "cement", "fly ash", "slag", "silica fume", "steel", "structural steel", "stainless steel", "timber", "wood", "glulam", "cross laminated timber", "masonry", "brick", "cmu", "asphalt", "bitumen", "insulation", "mineral wool", "fiberglass", "cellulose", "eps", "xps", "polyurethane"],
    "properties": ["compressive strength", "tensile strength", "flexural strength", "modulus", "durability", "permeability", "porosity", "diffusivity", "chloride penetration", "thermal conductivity", "fire resistance", "shrinkage", "creep", "workability"],
    "more": ["increased", "improved", "higher", "enhanced"],
    "less": ["decreased", "reduced", "lower", "degraded"],
    "tests": ["test", "tested", "measured", "results", "specimen", "samples"],
}
STANDARD_PATTERN = r"\b(astm\s*[a-z]?\s*\d+|aci\s*\d+|asce\s*\d+|iso\s*\d+|eurocode\s*\d+|ibc\s*\d+|iecc\s*\d+|ashrae\s*[\d.]+)\b"
ENERGY_WINDOW = 7

# --- construction documents: event type, first terms, context terms
CONSTRUCTION_EVENTS = [
    ("moisture_failure", ["moisture", "water intrusion", "water leakage", "condensation", "vapor", "wetting"], ["failure", "issue", "problem", "damage", "mold", "rot", "leak", "leakage", "poor"]),
    ("thermal_performance", ["thermal", "temperature", "heat", "cold", "r-value", "u-value", "insulation"], ["performance", "resistance", "loss", "transfer", "control", "retention", "insulate"]),
    ("insulation_strategy", ["insulation", "spray foam", "rigid foam", "batt", "continuous insulation", "air barrier"], ["strategy", "assembly", "layer", "retrofit", "detail", "exterior", "interior"]),
    ("air_sealing_issue", ["air sealing", "air leakage", "airtightness", "infiltration", "exfiltration", "sealant"], ["issue", "problem", "leak", "leakage", "failure", "gap", "draft"]),
    ("vapor_control", ["vapor", "vapour", "vapor diffusion", "vapor retarder", "vapor barrier", "vapor control"], ["control", "retarder", "barrier", "diffusion", "perm", "condensation"]),
    ("structural_failure", ["beam", "column", "slab", "foundation", "wall", "roof", "connection", "panel", "truss", "joist"], ["failure", "crack", "cracking", "collapse", "buckling", "deflection", "shear", "settlement", "spalling"]),
    ("material_degradation", ["corrosion", "weathering", "degradation", "deterioration", "delamination", "fatigue", "freeze-thaw"], ["damage", "loss", "degrade", "degraded", "decay", "rot", "mold", "spalling"]),
    ("code_or_standard_reference", ["iecc", "astm", "asce", "aci", "ul", "iso", "en standard", "code", "standard"], ["reference", "compliance", "requirement", "section", "chapter", "table", "clause"]),
    ("durability_finding", ["durability", "service life", "lifespan", "long-term", "weathering resistance"], ["finding", "performance", "resistance", "assessment", "study", "evidence"]),
    ("construction_method", ["assembly", "retrofit", "installation", "construction", "framing", "enclosure", "detailing", "building"], ["method", "approach", "procedure", "system", "detail", "technique"]),
    ("climate_load", ["climate zone", "climate load", "snow load", "wind load", "rain load", "degree days", "heating degree days", "cooling degree days", "climate normals"], ["building", "buildings", "performance", "moisture", "risk", "heating", "cooling", "insulation", "vapor", "vapour", "durability", "material", "wall", "roof", "attic", "foundation", "assembly", "duct", "condensation", "load"]),
]
CLIMATE_TERMS = ["climate zone", "climate load", "degree days", "heating degree days", "cooling degree days", "climate normals"]
BUILDING_CONTEXT = ["building", "buildings", "envelope", "performance", "moisture", "risk", "heating", "cooling", "insulation", "vapor", "vapour", "durability", "material", "wall", "roof", "attic", "foundation", "assembly", "duct", "condensation", "load"]
FRONT_MATTER = ["table of contents", "contents", "list of acronyms", "executive summary", "disclaimer", "authors", "acknowledgments", "acknowledgements", "copyright", "all rights reserved", "references", "bibliography", "about this report"]
BOILERPLATE_WORDS = ["temperature", "humidity", "pressure", "volume", "table", "normals"]
ACTION_TERMS = ["load", "performance", "failure", "damage", "strategy", "control", "reference", "issue"]
MONTHS = ["jan", "january", "feb", "february", "mar", "march", "apr", "april", "may", "jun", "june", "jul", "july", "aug", "august", "sep", "sept", "september", "oct", "october", "nov", "november", "dec", "december"]
CLIMATE_PLACES = ["canada", "canadian", "toronto", "vancouver", "calgary", "edmonton", "ottawa", "montreal", "quebec", "halifax", "winnipeg", "regina", "saskatoon", "victoria", "whitehorse", "yellowknife", "iqaluit", "alberta", "british columbia", "manitoba", "saskatchewan", "nova scotia", "new brunswick", "newfoundland", "labrador"]

# --- overlays: weights of terms in a snippet, and of entity types
OVERLAYS = {
    "science_research_v1": {
        "boost": {"mechanism": 3, "pathway": 3, "dose-dependent": 2, "in vivo": 3, "in vitro": 1, "replication": 4, "independent cohort": 4, "statistically significant": 3, "p-value": 2, "randomized": 3, "controlled": 3, "clinical trial": 4, "phase i": 3, "phase ii": 3, "phase iii": 4, "limitations": 2, "confounding": 2, "causal": 3, "biomarker": 2, "translational": 3, "lc-ms": 2, "mass spectrometry": 2, "elisa": 2, "western blot": 2, "flow cytometry": 2, "rna-seq": 2, "immunohistochemistry": 2, "confocal microscopy": 2},
        "demote": {"anecdotal": -2, "self-reported": -2, "lifestyle": -1, "stack": -1, "biohack": -1, "optimization": -1, "routine": -1, "efficacy": -3, "effective": -2, "effectiveness": -2},
        "priority": {"pathway": 2, "assay": 2, "model": 2, "compound": 1, "indication": 2},
    },
    "biohacking_curiosity_v1": {
        "boost": {"protocol": 3, "stack": 3, "dosage": 2, "cycle": 2, "optimization": 2, "self-experiment": 3, "sleep": 2, "energy": 2, "focus": 2, "cognition": 2, "anti-aging": 3, "longevity": 2, "performance": 2, "recovery": 2, "metabolism": 2, "supplement": 2, "tracking": 1, "biomarker": 1, "heart rate variability": 1, "glucose": 1, "vo2 max": 1},
        "demote": {"in vitro": -1, "cell line": -1, "rodent model": -1, "pathway": -1, "molecular mechanism": -1, "assay": -1},
        "priority": {"compound": 2, "indication": 2, "model": 1, "pathway": 1, "assay": 0.5},
    },
    "construction_research_v1": {"boost": {}, "demote": {}, "priority": {}},
    "climate_resilience_v1": {
        "boost": {
            "freeze-thaw": 3, "freeze thaw": 3, "frost action": 3, "frost damage": 3, "chloride ingress": 3, "chloride attack": 3, "salt attack": 3, "deicing salts": 3,
            "de-icing salts": 3, "salt spray": 3, "carbonation": 3, "carbonation depth": 3, "CO2 attack": 3, "sulfate attack": 3, "sulfate corrosion": 3, "coastal exposure": 3,
            "marine environment": 3, "relative humidity": 2, "RH": 2, "thermal cycling": 2, "temperature cycling": 2, "wetting/drying": 2, "humidity cycling": 2, "UV exposure": 2,
            "solar radiation": 2, "wind-driven rain": 2, "high wind": 2, "seismic": 2, "flood": 2, "arctic": 2, "tropical": 2, "climate": 1.5, "resilience": 1.5, "adaptation": 1.5,
            "hazard": 1.5, "extreme weather": 2.5, "temperature extremes": 2.5, "precipitation": 2, "rainfall": 2, "snow load": 2, "ice formation": 2, "condensation": 2,
            "moisture ingress": 2, "water intrusion": 2, "thermal shock": 2.5, "thermal stress": 2, "expansion joints": 2, "control joints": 2, "crack control": 2,
            "drying shrinkage": 2, "plastic shrinkage": 2, "creep": 2, "stress relaxation": 2, "load redistribution": 2, "structural integrity": 2, "service life": 2, "durability": 2,
            "performance degradation": 2, "material degradation": 2, "corrosion protection": 2, "weathering resistance": 2, "freeze protection": 2, "thermal insulation": 2,
            "moisture control": 2, "vapor barrier": 2, "air barrier": 2, "waterproofing": 2, "drainage": 2, "ventilation": 2, "airtightness": 2, "thermal bridge": 2,
            "heat transfer": 2, "thermal conductivity": 2, "R-value": 2, "U-value": 2, "thermal mass": 2, "heat capacity": 2, "specific heat": 2, "thermal expansion coefficient": 2,
            "coefficient of thermal expansion": 2, "moisture diffusion": 2, "vapor diffusion": 2, "permeability": 2, "perm rating": 2, "water absorption": 2, "sorption": 2,
            "desorption": 2, "equilibrium moisture content": 2, "absolute humidity": 2, "dew point": 2, "condensation point": 2, "wet bulb temperature": 2, "dry bulb temperature": 2,
            "ambient temperature": 2, "surface temperature": 2, "core temperature": 2, "temperature gradient": 2, "thermal gradient": 2, "temperature differential": 2,
            "thermal differential": 2, "heat flow": 2, "heat flux": 2, "heat transfer coefficient": 2, "convection": 2, "conduction": 2, "radiation": 2, "solar gain": 2,
            "solar heat gain": 2, "infrared radiation": 2, "ultraviolet radiation": 2, "electromagnetic radiation": 2, "thermal radiation": 2, "black body radiation": 2,
            "gray body radiation": 2, "emissivity": 2, "absorptivity": 2, "reflectivity": 2, "transmissivity": 2, "opacity": 2, "transparency": 2, "translucency": 2, "haze": 2,
            "clarity": 2, "turbidity": 2, "cloudiness": 2, "fogging": 2, "fog": 2, "mist": 2, "dew": 2, "frost": 2, "ice": 2, "snow": 2, "hail": 2, "sleet": 2, "drizzle": 2,
            "rain": 2, "storm": 2, "hurricane": 2, "tornado": 2, "cyclone": 2, "typhoon": 2, "monsoon": 2, "drought": 2, "heat wave": 2, "cold snap": 2, "temperature inversion": 2,
            "thermal inversion": 2, "atmospheric pressure": 2, "barometric pressure": 2, "air pressure": 2, "wind pressure": 2, "wind load": 2, "wind speed": 2, "wind direction": 2,
            "wind velocity": 2, "wind turbulence": 2, "wind shear": 2, "gust": 2, "gust factor": 2, "gust response": 2, "dynamic pressure": 2, "static pressure": 2,
            "differential pressure": 2, "pressure differential": 2, "pressure gradient": 2, "pressure drop": 2, "pressure loss": 2, "pressure recovery": 2, "pressure distribution": 2,
            "pressure coefficient": 2, "pressure tap": 2, "pressure sensor": 2, "pressure transducer": 2, "pressure gauge": 2, "pressure meter": 2, "pressure indicator": 2,
            "pressure recorder": 2, "pressure data logger": 2, "pressure monitoring": 2, "pressure measurement": 2, "pressure testing": 2, "pressure test": 2, "pressure check": 2,
            "pressure verification": 2, "pressure validation": 2, "pressure calibration": 2, "pressure adjustment": 2, "pressure regulation": 2, "pressure control": 2,
            "pressure management": 2,
        },
        "demote": {"theoretical": -1, "conceptual": -1, "simulation": -0.5, "modeling": -0.5},
        "priority": {"environment": 1.5, "failure_mode": 1.5, "hazard": 1.5, "material": 1.2, "system": 1.2},
    },
}
ASSAY_KEYWORDS = ["lc-ms", "elisa", "western blot", "rna-seq", "flow cytometry", "mass spectrometry", "hplc", "nmr", "fluorescence", "spectrometry"]
CO_CLIMATE = ["freeze-thaw", "freeze thaw", "frost", "chloride", "salt", "carbonation", "thermal", "temperature", "humidity", "uv", "solar", "wind", "seismic", "flood", "arctic", "tropical", "climate", "resilience", "adaptation"]
CO_MATERIAL = ["concrete", "steel", "wood", "glass", "brick", "masonry", "foundation", "beam", "column", "wall", "roof", "floor", "insulation", "coating"]
INFRASTRUCTURE = ["human", "humans", "serum", "plasma", "blood", "tissue", "in vivo", "in vitro"]
MODEL_WEIGHTS = {"human": 2.0, "humans": 2.0, "primary human cells": 1.8, "human tissue": 1.9, "biopsy": 1.8, "tissue": 1.7, "csf": 1.7, "cerebrospinal fluid": 1.7, "plasma": 1.6, "serum": 1.6, "blood": 1.6, "clinical sample": 1.9, "patient": 1.9, "patients": 1.9, "non-human primate": 1.4, "primate": 1.4, "pig": 1.3, "organoid": 1.4, "organoids": 1.4, "ipsc": 1.4, "ipsc-derived": 1.4, "ex vivo": 1.3, "xenograft": 1.3, "xenografts": 1.3, "mouse": 1.0, "mice": 1.0, "rat": 1.0, "rats": 1.0, "zebrafish": 1.0, "drosophila": 0.9, "c. elegans": 0.9, "worm": 0.9, "cell line": 0.7, "cell lines": 0.7, "hek293": 0.6, "hek-293": 0.6, "hela": 0.6, "cho": 0.6, "lysate": 0.55, "cell-free": 0.5, "cell-free system": 0.5, "in vitro": 0.8}
BUCKETS = [("strong", 80), ("promising", 60), ("exploratory", 40), ("stalled", 20)]
LAST_BUCKET = "deprioritized"

# --- pattern intelligence
SIGNALS = {
    "positive": ["significant improvement", "significantly improved", "robust effect", "effective", "enhanced", "outperformed", "increased significantly", "demonstrated efficacy", "strong response", "beneficial effect", "superior", "potent", "promising", "successful", "improved stability", "increased activity", "enhanced performance", "better than", "higher efficacy", "reduced degradation"],
    "neutral": ["investigated", "examined", "evaluated", "characterized", "assessed", "analyzed", "measured", "explored", "observed", "studied", "tested", "compared", "determined", "identified", "detected", "monitored", "screened", "profiled"],
    "negative": ["no significant effect", "did not improve", "failed to", "limited effect", "inconsistent results", "no difference", "poor stability", "low efficacy", "unable to", "not effective", "no improvement", "decreased", "reduced activity", "unstable", "degraded", "aggregated", "insoluble", "toxic", "adverse", "insufficient"],
    "replication": ["replicated", "reproduced", "validated", "confirmed", "consistent with previous studies", "in agreement with", "corroborated", "verified", "supported by", "in line with", "similar to previous", "as reported", "consistent with literature"],
}
PROBLEM_NAMES = ["aggregation", "degradation", "instability", "toxicity", "poor"]
ESCALATION_TERMS = ["in vivo", "clinical", "human", "patient", "phase"]
PATTERN_BASE = {"convergence": 40, "escalation": 45, "fragmentation": 20, "stagnation": 10, "abandonment": 0}
MOMENTUM_POINTS = {"increasing": 10, "stable": 5, "decreasing": -10}
CONFIDENCE_FACTOR = {"high": 1.1, "med": 1.0, "low": 0.9}
HEALTH_TEXT = [(80, "strong research momentum"), (60, "promising and active research"), (40, "exploratory research"), (20, "stalled or uncertain research"), (-1, "declining research attention")]
PATTERN_TEXT = {"convergence": "with convergence around consistent methods", "escalation": "with increasing validation efforts", "stagnation": "encountering persistent technical barriers", "abandonment": "with declining research interest", "fragmentation": "remaining methodologically diverse"}
PATTERN_EMPHASIS = {"convergence": 1.10, "escalation": 1.15, "fragmentation": 1.05, "stagnation": 0.95, "abandonment": 0.90}

# --- canonical types and governance
GLOBAL_TYPES = {"neural_cell": ["microglia", "astrocyte", "neuron", "neurons", "astrocytes", "microglial", "neuronal", "astrocytic"], "stem_cell": ["ipsc", "msc", "esc"], "model": ["organoid", "organoids"]}
DOMAIN_TYPES = {
    "environment": ["ice", "water", "air", "moisture", "humidity", "temperature", "heat", "cold", "frost", "snow", "vapor", "climate", "weather", "acoustic", "sound", "thaw", "freeze"],
    "hazard": ["corrosion", "fire", "wind", "seismic", "earthquake", "flood", "storm", "lightning", "tornado", "impact"],
    "material": ["steel", "concrete", "wood", "glass", "brick", "masonry", "plastic", "polymer", "composite", "aluminum", "copper", "board", "insulation", "panel", "coating", "timber"],
    "system": ["structure", "building", "foundation", "roof", "wall", "floor", "frame", "assembly", "component", "door", "ventilation", "building envelope", "column", "heating", "cooling", "mechanical", "electrical"],
    "failure_mode": ["failure", "collapse", "crack", "fracture", "buckling", "deflection", "deformation", "leakage", "damage", "rot", "deterioration", "weathering", "decay", "expansion", "creep", "shrinkage"],
    "test_method": ["test", "method", "guideline", "standard", "procedure", "protocol", "assay", "approach", "practice", "technique", "specification", "requirement", "code", "strategy"],
}
PROCESS_WORDS = ["quantification", "quantitation", "purification", "calibration", "validation", "optimization", "quality control", "measurement", "determination", "analysis", "testing", "evaluation", "assessment", "inspection", "monitoring", "surveying", "report", "documentation", "record", "log", "procedure", "protocol", "method", "technique"]
HIGH_VALUE_TYPES = {"construction_science": ["material", "system", "failure_mode", "environment", "hazard"]}
DEFAULT_HIGH_VALUE = ["compound", "target", "stem_cell"]
ASSAY_TYPES = ["assay", "test_method", "measurement"]
MODEL_CONTEXT = ["in vivo", "in vitro", "human", "rat", "mouse", "plasma", "serum", "blood", "tissue", "cell culture", "fbs", "site test", "load test", "structural analysis", "field trial", "field test", "lab test", "material test", "failure analysis", "environmental exposure", "hazard assessment"]
TYPE_WEIGHTS = {"compound": 0.30, "target": 0.30, "assay": 0.20, "model": 0.10, "pathway": 0.15, "indication": 0.10, "stem_cell": 0.20, "peptide_class": 0.05}
BIOMEDICAL_TYPES = ["compound", "target", "pathway", "indication", "assay", "peptide"]
AFFILIATIONS = ["university", "institute", "department", "dept", "school", "hospital", "center", "centre", "faculty", "college", "clinic", "laboratory", "lab", "company", "corporation", "inc", "llc", "ltd", "email", "@", ".edu", ".org", ".com", "http://", "https://"]
ABSTRACT_PATTERNS = [
    r'(?is)<div[^>]*class="abstract"[^>]*>(.*?)</div>',
    r'(?is)<div[^>]*class="abstractSection"[^>]*>(.*?)</div>',
    r'(?is)<p[^>]*class="abstract"[^>]*>(.*?)</p>',
    r'(?is)<div[^>]*id="abstract"[^>]*>(.*?)</div>',
    r"(?is)Abstract</h2>\s*<p>(.*?)</p>",
    r"(?is)ABSTRACT</h2>\s*<p>(.*?)</p>",
]
PDF_LINK = r"(?i)https?://[^\s<>\"']+\.pdf(?:\?[^\s<>\"']*)?(?:#[^\s<>\"']*)?"
DOI_PREFIXES = ["https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/", "doi:"]

# --- scored extraction: writings by which a term of an ontology is known, the term itself first
ABBREVIATIONS_OF_TERMS = {
    "concrete": ["concrete", "conc", "cocrete"], "steel": ["steel", "stl"], "wood": ["wood", "timber", "lumber"], "glass": ["glass", "glz"], "brick": ["brick", "brk"],
    "masonry": ["masonry", "msonry"], "foundation": ["foundation", "found", "fdn"], "beam": ["beam", "bm"], "column": ["column", "col", "clm"], "wall": ["wall", "wl"],
    "roof": ["roof", "rf"], "floor": ["floor", "flr"], "insulation": ["insulation", "insul", "ins"], "moisture": ["moisture", "moist", "mstr"],
    "corrosion": ["corrosion", "corrode", "corr"], "durability": ["durability", "durable", "dur"], "strength": ["strength", "str", "stren"],
    "performance": ["performance", "perf", "prf"], "failure": ["failure", "fail", "fl"], "crack": ["crack", "crk"], "deflection": ["deflection", "defl", "def"],
    "settlement": ["settlement", "settl", "sett"], "load": ["load", "ld"], "stress": ["stress", "strs"], "strain": ["strain", "strn"],
    "temperature": ["temperature", "temp", "tmp"], "humidity": ["humidity", "humid", "hum"], "fire": ["fire", "flame", "fr"], "water": ["water", "wtr", "h2o"],
    "vapor": ["vapor", "vpr"], "air": ["air"], "wind": ["wind", "wnd"], "seismic": ["seismic", "earthquake", "eq"], "snow": ["snow", "snw"], "ice": ["ice", "ic"],
    "frost": ["frost", "frst"], "freeze": ["freeze", "frz"], "thaw": ["thaw", "thw"], "thermal": ["thermal", "therm", "th"], "acoustic": ["acoustic", "sound", "ac"],
    "structural": ["structural", "struct", "str"], "mechanical": ["mechanical", "mech", "mc"], "chemical": ["chemical", "chem", "ch"], "physical": ["physical", "phys", "ph"],
    "environmental": ["environmental", "env", "envr"], "building": ["building", "bldg", "bld"], "construction": ["construction", "const", "cnst"],
    "design": ["design", "des", "ds"], "analysis": ["analysis", "anal", "anl"], "test": ["test", "tst"], "method": ["method", "meth", "mth"],
    "procedure": ["procedure", "proc", "prc"], "standard": ["standard", "std", "stnd"], "code": ["code", "cd"], "specification": ["specification", "spec", "spc"],
    "requirement": ["requirement", "req", "rqr"], "guideline": ["guideline", "guid", "gdl"], "practice": ["practice", "prac", "pr"], "technique": ["technique", "tech", "tch"],
    "approach": ["approach", "app", "apr"], "strategy": ["strategy", "strat", "stg"], "solution": ["solution", "sol", "sl"], "system": ["system", "sys", "sys"],
    "component": ["component", "comp", "cmp"], "element": ["element", "elem", "elm"], "member": ["member", "mem", "mbr"], "connection": ["connection", "conn", "cn"],
    "joint": ["joint", "jnt"], "anchor": ["anchor", "anch", "anc"], "fastener": ["fastener", "fast", "fst"], "bolt": ["bolt", "blt"], "screw": ["screw", "scr"],
    "nail": ["nail", "nl"], "weld": ["weld", "wld"], "adhesive": ["adhesive", "adhs", "adh"], "sealant": ["sealant", "seal", "sl"], "coating": ["coating", "coat", "ct"],
    "paint": ["paint", "pnt"], "finish": ["finish", "fnsh", "fn"], "surface": ["surface", "surf", "sf"], "interface": ["interface", "intf", "if"],
    "boundary": ["boundary", "bnd", "bd"], "transition": ["transition", "trans", "tr"], "junction": ["junction", "jnc", "jct"], "intersection": ["intersection", "intr", "ix"],
    "penetration": ["penetration", "pen", "pn"], "opening": ["opening", "opn", "op"], "void": ["void", "vd"], "cavity": ["cavity", "cav", "cv"], "gap": ["gap", "gp"],
    "fissure": ["fissure", "fis", "fs"], "fracture": ["fracture", "frac", "fr"], "split": ["split", "splt", "sp"], "tear": ["tear", "tr"], "rip": ["rip", "rp"],
    "break": ["break", "brk"], "damage": ["damage", "dm", "dg"], "deterioration": ["deterioration", "deter", "dt"], "degradation": ["degradation", "degrad", "dg"],
    "decay": ["decay", "dcy", "dc"], "rot": ["rot", "rt"], "oxidation": ["oxidation", "oxid", "ox"], "weathering": ["weathering", "weather", "wth"],
    "erosion": ["erosion", "eros", "er"], "wear": ["wear", "wr"], "fatigue": ["fatigue", "fat", "ft"], "creep": ["creep", "crp"], "shrinkage": ["shrinkage", "shrink", "shk"],
    "expansion": ["expansion", "expand", "exp"], "contraction": ["contraction", "contract", "cont"], "movement": ["movement", "move", "mv"],
    "displacement": ["displacement", "displace", "dsp"], "deformation": ["deformation", "deform", "dfm"], "distortion": ["distortion", "distort", "dstr"],
    "buckling": ["buckling", "buckle", "bkl"], "sag": ["sag", "sg"], "bow": ["bow", "bw"], "twist": ["twist", "twt", "tw"], "warp": ["warp", "wrp"],
    "camber": ["camber", "cmb"], "slope": ["slope", "slp"], "grade": ["grade", "grd"], "pitch": ["pitch", "ptch", "pt"], "angle": ["angle", "ang", "ag"],
    "orientation": ["orientation", "orient", "ort"], "alignment": ["alignment", "align", "aln"], "position": ["position", "pos", "ps"], "location": ["location", "loc", "lc"],
    "placement": ["placement", "place", "plc"], "installation": ["installation", "install", "inst"], "erection": ["erection", "erect", "er"],
    "assembly": ["assembly", "assem", "asm"], "fabrication": ["fabrication", "fabric", "fab"], "manufacturing": ["manufacturing", "manufact", "mfg"],
    "production": ["production", "product", "prod"],
}
#: By field and kind of context, the patterns of which one must be in the text.
CONTEXT_PATTERNS = {
    "construction": {
        "material_context": [
            r"(?:material|construction|building|structural).*?(?:test|analysis|performance)", r"(?:concrete|steel|wood|glass).*?(?:strength|durability|performance)",
            r"(?:material|component).*?(?:failure|degradation|corrosion)",
        ],
        "system_context": [
            r"(?:system|assembly|component).*?(?:performance|failure|analysis)", r"(?:wall|roof|foundation).*?(?:design|analysis|performance)",
        ],
        "environment_context": [
            r"(?:environment|condition|exposure).*?(?:effect|impact|performance)", r"(?:temperature|humidity|corrosive).*?(?:effect|impact|performance)",
        ],
    },
    "biomedical": {
        "compound_context": [
            r"(?:compound|drug|molecule).*?(?:activity|efficacy|potency)", r"(?:inhibit|activate|bind).*?(?:target|receptor|enzyme)",
        ],
        "target_context": [
            r"(?:target|receptor|enzyme).*?(?:expression|activity|function)", r"(?:protein|gene).*?(?:expression|mutation|variant)",
        ],
        "assay_context": [
            r"(?:assay|test|analysis).*?(?:result|measurement|data)", r"(?:ic50|ec50|kd|ki).*?(?:value|measurement|result)",
        ],
    },
}
#: Words taken from a text with such a context.
CONTEXT_WORDS = {
    "material_context": ("material", [r"\b(concrete|steel|wood|glass|brick|masonry)\b", r"\b(strength|durability|performance)\b"]),
    "system_context": ("system", [r"\b(wall|roof|foundation|beam|column)\b", r"\b(system|assembly|component)\b"]),
    "environment_context": ("environment", [r"\b(temperature|humidity|corrosive|exposure)\b", r"\b(environment|condition)\b"]),
}
#: Candidates for entities where the scored stages find few, by field and kind, and the words that tell a candidate's kind.
FALLBACK_PATTERNS = {
    "construction": {
        "material_patterns": [
            r"\b(?:high[-\s]?strength|reinforced|prestressed|fiber[-\s]?reinforced|carbon[-\s]?fiber|glass[-\s]?fiber)\s+(?:concrete|steel|polymer)\b",
            r"\b(?:structural|load[-\s]?bearing|bearing|supporting)\s+(?:beam|column|wall|slab)\b",
            r"\b(?:thermal|acoustic|fire|water|vapor)\s+(?:insulation|barrier|resistance|proof)\b", r"\b(?:sealant|adhesive|coating|paint|finish)\b",
            r"\b(?:aggregate|gravel|sand|cement|mortar|grout)\b",
        ],
        "system_patterns": [
            r"\b(?:load[-\s]?bearing|structural|supporting|bearing)\s+(?:system|assembly|framework)\b", r"\b(?:foundation|footing|pile|raft|slab)\b",
            r"\b(?:roofing|cladding|façade|curtain\s+wall)\b", r"\b(?:HVAC|plumbing|electrical|mechanical)\s+(?:system|installation)\b",
            r"\b(?:seismic|wind|snow|live|dead)\s+(?:load|resistance)\b",
        ],
        "environment_patterns": [
            r"\b(?:corrosive|harsh|extreme|aggressive)\s+(?:environment|condition)\b", r"\b(?:marine|coastal|industrial|urban|rural)\s+(?:environment|exposure)\b",
            r"\b(?:freeze[-\s]?thaw|thermal|moisture|humidity)\s+(?:cycle|variation)\b", r"\b(?:UV|ultraviolet|solar|weathering)\s+(?:exposure|degradation)\b",
            r"\b(?:chemical|biological|physical)\s+(?:attack|degradation)\b",
        ],
        "failure_patterns": [
            r"\b(?:structural|mechanical|material)\s+(?:failure|collapse|buckling)\b", r"\b(?:cracking|crack|fissure|fracture|split)\b",
            r"\b(?:corrosion|rust|oxidation|deterioration)\b", r"\b(?:deflection|deformation|distortion|sagging)\b", r"\b(?:leakage|water\s+intrusion|moisture\s+damage)\b",
        ],
    },
    "biomedical": {
        "compound_patterns": [
            r"\b(?:small[-\s]?molecule|peptide|protein|antibody|enzyme|inhibitor|activator)\b", r"\b(?:drug|compound|molecule|agent|substance)\s+(?:X\d+|[A-Z]{2,}\d+)\b",
            r"\b(?:IC50|EC50|KD|Ki|IC90|EC90)\s*[<>=]?\s*\d+[\s\w]*\b", r"\b(?:potent|effective|active|inactive|weak)\s+(?:compound|drug|inhibitor)\b",
            r"\b(?:synthetic|natural|organic|inorganic)\s+(?:compound|molecule)\b",
        ],
        "target_patterns": [
            r"\b(?:protein|enzyme|receptor|channel|transporter)\s+(?:[A-Z][A-Z0-9]+)\b", r"\b(?:gene|mutation|variant|polymorphism)\s+(?:[A-Z][A-Z0-9]+)\b",
            r"\b(?:cell|tissue|organ)\s+(?:line|type|specific)\b", r"\b(?:pathway|signal|cascade|network)\s+(?:[A-Z][A-Z0-9]+)\b",
            r"\b(?:binding|interaction|expression|activity)\s+(?:assay|test)\b",
        ],
        "assay_patterns": [
            r"\b(?:ELISA|HPLC|LC-MS|MS/MS|NMR|X-ray|crystallography)\b", r"\b(?:in\s+vitro|in\s+vivo|ex\s+vivo)\s+(?:assay|test|experiment)\b",
            r"\b(?:dose[-\s]?response|time[-\s]?course|kinetic)\s+(?:study|assay)\b", r"\b(?:cell[-\s]?based|biochemical|functional)\s+(?:assay|screen)\b",
            r"\b(?:high[-\s]?throughput|HTS|screening)\s+(?:assay|platform)\b",
        ],
    },
}
FALLBACK_KEYWORDS = {
    "construction": {
        "material_keywords": [
            "concrete", "steel", "wood", "glass", "brick", "masonry", "insulation", "sealant", "coating", "paint", "aggregate", "cement", "mortar",
        ],
        "system_keywords": [
            "beam", "column", "wall", "slab", "foundation", "roof", "floor", "frame", "structure", "assembly", "component",
        ],
        "environment_keywords": [
            "temperature", "humidity", "corrosion", "exposure", "weathering", "freeze", "thaw", "UV", "solar", "marine", "industrial",
        ],
        "failure_keywords": [
            "failure", "collapse", "crack", "fracture", "corrosion", "deterioration", "deflection", "deformation", "leakage", "damage", "buckling",
        ],
    },
    "biomedical": {
        "compound_keywords": [
            "compound", "drug", "molecule", "inhibitor", "activator", "ligand", "substrate", "product", "metabolite", "peptide", "protein",
        ],
        "target_keywords": [
            "protein", "enzyme", "receptor", "channel", "transporter", "gene", "mutation", "variant", "cell", "tissue", "organ",
        ],
        "assay_keywords": [
            "assay", "test", "experiment", "screen", "analysis", "measurement", "IC50", "EC50", "KD", "Ki", "activity", "binding",
        ],
    },
}
# --- seed lint
PROBLEMATIC_TERMS = {
    "MS": "Multiple Sclerosis vs Mass Spectrometry", "KI": "Inhibition constant vs part of 'kinase'", "RB": "Retinoblastoma vs Rubidium", "NA": "Sodium (too generic)",
    "K": "Potassium (too generic)", "CA": "Calcium (too generic)", "IC": "Inhibitory Concentration vs part of 'clinical'", "EC": "Effective Concentration (needs word boundary)",
}
COMMON_TERMS = ["cell", "cells", "tissue", "protein", "peptide", "drug", "compound", "receptor", "enzyme", "factor", "system", "process", "pathway", "response", "signaling", "metabolism", "synthesis", "degradation"]
CAPITALIZED = r"\b(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\b"
NO_ENTITY_PHRASES = [
    r"^(?:the|a|an|this|that|these|those|our|your|my|his|her|its)\b", r"\b(?:study|analysis|result|data|method|approach|technique|process|system)\b$",
    r"\b(?:based|related|associated|involved|including|containing)\b", r"\b(?:from|with|for|by|on|in|at|to|of|as|is|are|was|were)\b",
]
ENTITY_CODES = r"(?i)\b(?:[A-Z]{1,3}[-\s]?[0-9]{2,4}|[A-Z]{2,}[0-9]+|[0-9]+[A-Z]{1,3})\b"
#: Types of entities that are what a text is about, whatever their name.
PRIMARY_TYPES = ["gene", "protein", "compound", "cell_type", "assay", "test_method", "stem_cell", "neural_cell", "model", "peptide", "failure_mode", "target", "organism", "disease", "phenotype", "mutation", "variant", "tissue", "pathway", "biomarker", "receptor", "enzyme", "transcription_factor", "rna", "metabolite", "drug", "chemical", "exposure", "treatment", "intervention", "outcome", "measurement"]
#: Entity types that a domain's tables may hold; a domain without an entry may hold all.
_BUILDING_TYPES = ["material", "materials", "system", "systems", "failure_mode", "failure_modes", "environment", "environments", "hazard", "hazards", "test_method", "test_methods", "code", "codes", "property", "properties"]
_LIFE_TYPES = ["peptide", "compound", "target", "pathway", "indication", "model", "stem_cell", "neural_cell", "assay", "biomarker"]
ALLOWED_TYPES = {"construction_science": _BUILDING_TYPES, "biohacking_longevity": _LIFE_TYPES, "neuroscience_cognition": _LIFE_TYPES, "neuroscience": _LIFE_TYPES, "stem_cells_regen": _LIFE_TYPES, "drug_discovery": _LIFE_TYPES, "methods_tooling": _LIFE_TYPES}
ALL_TYPES = [*_LIFE_TYPES, *_BUILDING_TYPES]
