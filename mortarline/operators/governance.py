"""Domain profiles: allowed entity types, exclusions, forbidden language, audits and argument checks."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.functions import phrases as P


REQUIRED = ("id", "name", "description", "claims_mode", "domain_profile_version", "seed_overlays", "exclusions", "pattern_emphasis", "language")
BANNED_TYPES: dict[str, tuple[str, ...]] = {"construction_science": ("compound", "target", "pathway", "indication", "assay", "peptide")}


@dataclass(frozen=True)
class DomainProfile:
    id: str
    name: str
    description: str
    claims_mode: str
    version: str
    seed_files: tuple[str, ...]
    preferred_types: tuple[str, ...]
    excluded_terms: tuple[str, ...]
    forbidden: tuple[str, ...]
    emphasis: Mapping[str, float]
    overlays: tuple[str, ...] = ()
    dual_lens: bool = False
    allowed_phrases: tuple[str, ...] = field(default=())

    def excluded(self, text: Column) -> Column:
        """Whether a text has an excluded term: several words as a part, one word between boundaries."""
        terms = [t.strip().lower() for t in self.excluded_terms if t.strip()]
        s = F.lower(text)
        many, one = [t for t in terms if " " in t], [t for t in terms if " " not in t]
        out = F.lit(False)
        for t in many:
            out = out | F.contains(s, F.lit(t))
        if one:
            out = out | s.rlike(r"\b(?:" + "|".join(map(re.escape, one)) + r")\b")
        return F.coalesce(out, F.lit(False))

    def forbidden_language(self, text: Column) -> Column:
        s, out = F.lower(text), F.lit(False)
        for p in self.forbidden:
            if p.strip():
                out = out | F.contains(s, F.lit(p.strip().lower()))
        return F.coalesce(out, F.lit(False))


def profile_from(config: Mapping) -> DomainProfile:
    missing = [k for k in REQUIRED if k not in config]
    if missing:
        raise ValueError(f"domain profile lacks {', '.join(missing)}")
    dual = config.get("dual_lens", False)
    dual = bool(dual.get("enabled")) if isinstance(dual, Mapping) else bool(dual)
    seeds, language = config["seed_overlays"], config["language"]
    return DomainProfile(config["id"], config["name"], config["description"], config["claims_mode"], config["domain_profile_version"], tuple(seeds.get("include_files", ())), tuple(seeds.get("prefer_types", ())), tuple(config["exclusions"].get("terms", ())), tuple(language.get("forbidden", ())), {k: float(v) for k, v in config["pattern_emphasis"].items()}, tuple(config.get("overlays", ())), dual, tuple(config.get("output_allowed_phrases", ())))


def load_profiles(folder: str | Path) -> dict[str, DomainProfile]:
    """All profiles of a folder of JSON files; an id that occurs twice is an error."""
    out: dict[str, DomainProfile] = {}
    for path in sorted(Path(folder).glob("*.json")):
        p = profile_from(json.loads(path.read_text(encoding="utf-8")))
        if p.id in out:
            raise ValueError(f"domain id {p.id!r} occurs twice")
        out[p.id] = p
    return out


def valid_domain_id(value: str) -> str:
    """The id itself; anything that could leave a folder is an error."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", value or "") or ".." in value:
        raise ValueError(f"invalid domain id {value!r}")
    return value


def allowed_only(entities: DataFrame, domain: str, kind: str = "entity_type") -> DataFrame:
    """Entities of the types a domain may hold, as they are written; an unknown domain keeps all."""
    types = P.ALLOWED_TYPES.get(domain)
    return entities.where(F.col(kind).isin(*types)) if types else entities


def contaminated_types(domain: str) -> list[str]:
    """The known types that a domain may not hold; none for an unknown domain."""
    return [t for t in P.ALL_TYPES if t not in P.ALLOWED_TYPES[domain]] if domain in P.ALLOWED_TYPES else []


def contamination(entities: DataFrame, domain: str) -> DataFrame:
    """Count of entities of known types that a domain may not hold."""
    banned = contaminated_types(domain)
    rows = entities.where(F.col("entity_type").isin(*banned)) if banned else entities.where("false")
    return rows.groupBy("entity_type").agg(F.count("*").alias("n"))


def audit_domains(spark: SparkSession, profiles: Sequence[DomainProfile], overlay_files: Sequence[str] | None = None, seed_files: Sequence[str] | None = None) -> DataFrame:
    """domain_id, issue, what: preferred types not allowed, allowed ones not preferred, and banned ones preferred.

    With the names of the overlay and seed files there are, those that a profile
    names and that are missing as well.
    """
    rows = []
    for p in profiles:
        preferred, allowed, banned = dict.fromkeys(p.preferred_types), P.ALLOWED_TYPES.get(p.id, ()), BANNED_TYPES.get(p.id, ())
        rows += [(p.id, "preferred_not_allowed", t) for t in preferred if t not in allowed]
        rows += [(p.id, "allowed_not_preferred", t) for t in allowed if t not in preferred]
        rows += [(p.id, "leakage", t) for t in preferred if t in banned]
        if overlay_files is not None:
            rows += [(p.id, "missing_overlay", f"{o}.json") for o in p.overlays if f"{o}.json" not in overlay_files]
        if seed_files is not None:
            rows += [(p.id, "missing_seed", f) for f in p.seed_files if f not in seed_files]
    return spark.createDataFrame(rows, "domain_id string, issue string, entity_type string")


def audit_report(domains: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row per thing that is wrong: subject, issue.  ``domains`` as from audit_domains, ``feeds`` as from audit_feeds.

    Allowed types that are not preferred are no issue.
    """
    wrong = domains.where("issue <> 'allowed_not_preferred'").groupBy("domain_id", "issue").agg(F.array_join(F.array_sort(F.collect_list("entity_type")), ", ").alias("what"))
    one = wrong.select(F.col("domain_id").alias("subject"), F.concat("issue", F.lit(": "), "what").alias("issue"))
    return one.unionByName(feeds.where("missing_reason is not null").select(F.concat(F.lit("feed "), F.coalesce("name", F.lit("<unnamed>"))).alias("subject"), F.col("missing_reason").alias("issue")))


def report_text(report: DataFrame) -> str:
    """The report as text, 'ISSUES: none' if there are none; one line per domain or feed and issue."""
    lines = [f"- {r['subject']}: {r['issue']}" for r in report.orderBy("subject", "issue").collect()]
    return "\n".join(["ISSUES", *lines]) if lines else "ISSUES: none"


def audit_feeds(feeds: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every enabled feed with the reason it cannot be used, null if it can.  ``feeds``: name, url, domain and maybe enabled (null: yes); ``profiles``: domain_id."""
    known = profiles.select(F.col("domain_id").alias("domain"), F.lit(True).alias("known")).distinct()
    if "enabled" in feeds.columns:
        feeds = feeds.where(F.coalesce("enabled", F.lit(True)))
    reason = F.when(F.trim(F.coalesce("domain", F.lit(""))) == "", "missing domain").when(F.trim(F.coalesce("url", F.lit(""))) == "", "missing url").when(F.col("known").isNull(), "unknown domain")
    return feeds.join(F.broadcast(known), "domain", "left").select("name", "url", "domain", reason.alias("missing_reason"))  # known: one row per profile


def table_stats(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> DataFrame:
    """Rows and columns of tables of a directory."""
    out = None
    for n in names:
        df = spark.read.parquet(f"{sf_dir}/{n}.parquet")
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out


def checked_percentage(value: float) -> float:
    if not 0 <= value <= 1:
        raise ValueError(f"{value} is no share between 0 and 1")
    return value


def checked_positive(value: int, most: int | None = None) -> int:
    if value <= 0 or most is not None and value > most:
        raise ValueError(f"{value} is not a positive number" + (f" up to {most}" if most else ""))
    return value


def checked_memory(value: str) -> int:
    """Megabytes of '512M' or '2GB' (a GB counts 1000), between 100 and 16000."""
    m = re.fullmatch(r"\s*(\d+)\s*(gb?|mb?)?\s*", value, re.I)
    if not m:
        raise ValueError(f"no amount of memory: {value!r}")
    mb = int(m[1]) * (1000 if (m[2] or "m").lower().startswith("g") else 1)
    if not 100 <= mb <= 16_000:
        raise ValueError(f"{mb} MB is out of range")
    return mb


def checked_batch(value: int) -> int:
    return checked_positive(value, 1000)


def checked_path(value: str, must_exist: bool = False) -> Path:
    """A path without '..' that is not blank, and is there if it must be."""
    if not (value or "").strip() or ".." in Path(value).parts:
        raise ValueError(f"unsafe path {value!r}")
    if must_exist and not Path(value).exists():
        raise ValueError(f"no such path: {value}")
    return Path(value)


def overlay_version(profile: object | None) -> str:
    """overlay_version of a profile or its metadata, else its profile version, else v1."""
    metadata = getattr(profile, "metadata", None)
    found = getattr(profile, "overlay_version", None), metadata.get("overlay_version") if isinstance(metadata, Mapping) else None, getattr(profile, "domain_profile_version", None) or getattr(profile, "version", None)
    return next((v for v in found if v), "v1")


def seeds_version(environment: Mapping[str, str], described: str | None = None) -> str:
    """SEEDS_VERSION of the environment, else what the caller found out about the files, else unknown."""
    return environment.get("SEEDS_VERSION") or (described or "").strip() or "unknown"


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^https?://[^\s/$.?#][^\s]*$"), F.lit(False))


EXAMPLE_PROFILE = {
    "id": "construction_science", "name": "Construction", "description": "Materials and structures", "claims_mode": "observational_only", "domain_profile_version": "v1",
    "seed_overlays": {"include_files": ["materials.txt"], "prefer_types": ["material", "system", "failure_mode", "environment", "hazard", "test_method", "code", "assay"]},
    "exclusions": {"terms": ["coupon", "buy now", "best price", "in stock", "warranty", "sample"]}, "pattern_emphasis": {"convergence": 1.1}, "language": {"allowed": ["en"], "forbidden": ["proven solution", "guaranteed performance", "best material"]},
    "overlays": ["science_research_v1"], "dual_lens": {"enabled": True},
}


def excluded_sql(d, profile: DomainProfile, text: str) -> str:  # noqa: ANN001
    many, one = [t for t in profile.excluded_terms if " " in t], [t for t in profile.excluded_terms if " " not in t]
    return f"({d.has(text, many)} OR {d.word(text, one)})"


