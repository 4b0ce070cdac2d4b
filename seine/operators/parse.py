"""Job rows out of API bodies: by a platform's schema, or by aliases where there is none.

A body is parsed once, into a variant; every field is a read of the variant at a literal path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsons, text, times
from ..functions.rules import FIELD_ALIASES, JOB_ARRAYS, PLATFORM_ALIASES, SCHEMAS

FIELDS = ("external_id", "title", "location_raw", "city", "country_code", "department", "employment_type", "is_remote", "apply_url", "posted_at", "description", "raw_json")


def schema_registry(extra: dict[str, dict] | None = None) -> dict[str, dict]:
    """Known schemas with aliases and the caller's own; registering a platform is adding an entry."""
    known = SCHEMAS | (extra or {})
    return known | {alias: known[name] for alias, name in PLATFORM_ALIASES.items() if name in known}


def _by_platform(registry: dict[str, dict], pick: Callable[[dict], object], make: Callable[[object], Column], other: Column) -> Column:
    """One branch for each distinct thing that schemas say, whatever the number of platforms."""
    groups: dict[str, tuple[object, list[str]]] = {}
    for name, schema in registry.items():
        groups.setdefault(repr(pick(schema)), (pick(schema), []))[1].append(name)
    out = F.when(F.lit(False), other)
    for said, names in groups.values():
        if said:
            out = out.when(F.col("platform").isin(*names), make(said))
    return out.otherwise(other)


def _remote(value: Column, values: tuple[str, ...]) -> Column:
    kind = jsons.type_of(value)
    said = jsons.text_of(value)
    return F.coalesce(F.when(kind == "bool", said == "true").when(kind == "string", F.lower(said).isin(*[x.lower() for x in values])), F.lit(False))


def _lookup_specs(registry: dict[str, dict]) -> list[tuple]:
    return list(dict.fromkeys((id_field, array, tuple(fields.items())) for schema in registry.values() for id_field, array, fields in schema.get("lookups", ())))


def _lookup_map(rows: Column, fields: tuple[tuple[str, str], ...]) -> Column:
    """Number id to the fields of an array's objects, made once a body; of repeated ids the last counts."""
    string = lambda r, source: F.when(jsons.type_of(jsons.inside(r, source)) == "string", jsons.text_of(jsons.inside(r, source))).otherwise("")
    entry = lambda r, k: F.struct(F.when(jsons.type_of(jsons.inside(r, "id")) == "number", jsons.number_of(jsons.inside(r, "id"))).alias("id"), (-k).alias("late"), F.struct(*(string(r, source).alias(field) for field, source in fields)).alias("row"))
    known = F.sort_array(F.filter(F.transform(F.coalesce(jsons.items_of(rows), F.array().cast("array<variant>")), entry), lambda x: x["id"].isNotNull()))
    last = lambda x: F.filter(x, lambda one, k: (k == 0) | (one["id"] != F.get(x, k - 1)["id"]))
    return jsons.let(known, lambda x: F.map_from_entries(F.transform(last(x), lambda one: F.struct(one["id"], one["row"]))))


def _jobs(registry: dict[str, dict]) -> Column:
    """A body's jobs with what their references to other arrays of the same body stand for."""
    body = F.col("_doc")
    jobs = _by_platform(registry, lambda s: s["jobs_path"] or "$", lambda path: jsons.items_of(body if path == "$" else jsons.inside(body, path)), F.lit(None).cast("array<variant>"))
    specs = _lookup_specs(registry)
    if not specs:
        return F.transform(jobs, lambda j: F.struct(j.alias("job")))
    owns = lambda spec: F.col("platform").isin(*(name for name, s in registry.items() if any((a, b, tuple(c.items())) == spec for a, b, c in s.get("lookups", ()))))
    maps = F.struct(*(F.when(owns(spec), _lookup_map(jsons.inside(body, spec[1]), spec[2])).alias(f"m{k}") for k, spec in enumerate(specs)))

    def resolved(x: Column) -> Column:
        hit = lambda j, k, spec: jsons.let(jsons.number_of(jsons.inside(j, spec[0])), lambda wanted: F.when(wanted != 0, F.try_element_at(x["maps"][f"m{k}"], wanted)))
        return F.transform(x["jobs"], lambda j: F.struct(j.alias("job"), *(F.when(x["maps"][f"m{k}"].isNotNull(), hit(j, k, spec)).alias(f"hit{k}") for k, spec in enumerate(specs))))

    return jsons.let(F.struct(jobs.alias("jobs"), maps.alias("maps")), resolved)


def _fields(registry: dict[str, dict]) -> list[Column]:
    job = F.col("_job.job")
    empty = F.lit("")
    string = lambda name: _by_platform(registry, lambda s: s.get(name, ""), lambda path: jsons.string_of(jsons.inside(job, path)), empty)

    def identifier(said: tuple[str, bool]) -> Column:
        value = jsons.inside(job, said[0])
        number = jsons.number_of(value).cast("long")
        return F.when(number != 0, number.cast("string")).otherwise("") if said[1] else jsons.string_of(value)

    def posted(said: tuple[str, str]) -> Column:
        value = jsons.inside(job, said[0])
        return times.typed_time(jsons.text_of(value), jsons.type_of(value), said[1])

    found = {name: string(name) for name in ("title", "location_raw", "city", "country_code", "department", "apply_url", "description")}
    for k, (_, _, fields) in enumerate(_lookup_specs(registry)):
        hit = F.col(f"_job.hit{k}")
        for name, _ in fields:
            found[name] = F.when(hit.isNotNull(), hit[name]).otherwise(found[name])
    found |= {
        "external_id": _by_platform(registry, lambda s: (s["external_id"], s.get("id_is_int", False)), identifier, empty),
        "employment_type": _by_platform(registry, lambda s: s.get("employment_type") and (s["employment_type"], s.get("employment_types")), lambda x: text.employment_type(jsons.string_of(jsons.inside(job, x[0])), x[1]), empty),
        "is_remote": _by_platform(registry, lambda s: s.get("is_remote") and (s["is_remote"], s.get("remote_values", ())), lambda x: _remote(jsons.inside(job, x[0]), x[1]), F.lit(False)),
        "posted_at": _by_platform(registry, lambda s: s.get("posted_at") and (s["posted_at"], s.get("posted_format", "rfc3339")), posted, F.lit(None).cast("timestamp")),
        "raw_json": F.to_json(job),
    }
    return [found[name].alias(name) for name in FIELDS]


def parse_known(bodies: DataFrame, keep: list[str], extra: dict[str, dict] | None = None, platforms: list[str] | None = None) -> DataFrame:
    """Rows of jobs from ``platform`` and ``body``, with the ``keep`` columns and ``position`` in the array.

    One pass for all platforms. An unknown platform, a body that isn't JSON, a missing array,
    and a job without a title or an id give no rows.
    """
    registry = schema_registry(extra)
    registry = {name: registry[name] for name in platforms or registry}
    rows = bodies.where(F.col("platform").isin(*registry)).select(*keep, "platform", F.try_parse_json("body").alias("_doc")).where("_doc is not null")
    jobs = rows.select(*keep, "platform", F.posexplode(_jobs(registry)).alias("position", "_job"))
    return jobs.select(*keep, "platform", "position", *_fields(registry)).where("title <> '' and external_id <> ''")


def locate_jobs(body: Column, text_: Column) -> Column:
    """The array of jobs of a parsed body: the root, else what the first present alias holds that is an array or, at any depth, leads to one.

    Aliases can lie in each other at most as often as the text holds one before a brace, so that bounds the steps.
    """
    none = F.lit(None).cast("array<variant>")
    state = lambda doc, found: F.struct(doc.alias("doc"), found.alias("jobs"))

    def below(x: Column) -> Column:
        inner = lambda k: jsons.inside(x["doc"], k)
        held = F.coalesce(*(F.when(jsons.items_of(inner(k)).isNotNull() | jsons.is_object(inner(k)), inner(k)) for k in JOB_ARRAYS))
        return jsons.let(held, lambda v: state(v, jsons.items_of(v)))

    steps = F.regexp_count(text_, F.lit('"(?:' + "|".join(JOB_ARRAYS) + r')"\s*:\s*[{\[]'))
    step = lambda x, _: F.when(x["jobs"].isNotNull() | x["doc"].isNull(), x).otherwise(below(x))
    last = F.aggregate(F.sequence(F.lit(0), steps), state(body, F.coalesce(jsons.items_of(body), none)), step)
    return last["jobs"]


def infer_schema(envelopes: DataFrame, body_col: str = "raw_json", least: float = 0.5) -> DataFrame:
    """What a schema for an unknown platform could be: per field the alias that most of its jobs have, with their share.

    ``field``, ``alias``, ``jobs`` (that have it), ``share``; of aliases that tie the first counts, and a
    field that under ``least`` of the jobs have is left out.
    """
    rows = envelopes.select(F.col(body_col).alias("_body")).select("_body", F.try_parse_json("_body").alias("_doc")).where("_doc is not null")
    jobs = rows.select(F.explode(locate_jobs(F.col("_doc"), F.col("_body"))).alias("_job"))
    aliases = [(field, place, alias) for field, names in FIELD_ALIASES.items() for place, alias in enumerate(names)]
    has = lambda field, alias: (jsons.nested_of if field == "location" else jsons.rounded_of)(jsons.inside(F.col("_job"), alias)) != ""
    counts = jobs.agg(F.count("*").alias("n"), *(F.count_if(has(field, alias)).alias(f"c{k}") for k, (field, _, alias) in enumerate(aliases)))
    listed = F.array(*(F.struct(F.lit(field).alias("field"), F.col(f"c{k}").alias("jobs"), F.lit(-place).alias("first"), F.lit(alias).alias("alias")) for k, (field, place, alias) in enumerate(aliases)))
    best = counts.select("n", F.explode(listed).alias("x")).groupBy("x.field").agg(F.max(F.struct("x.jobs", "x.first", "x.alias", "n")).alias("b"))
    return best.select("field", "b.alias", "b.jobs", F.round(F.col("b.jobs") / F.col("b.n"), 6).alias("share")).where(F.col("b.jobs") >= F.lit(least) * F.col("b.n")).where("jobs > 0")


def parse_heuristic(envelopes: DataFrame, keep: list[str], body_col: str = "raw_json") -> DataFrame:
    """Rows of jobs by field aliases, from an envelope's JSON, which may also be a string of JSON.

    A job without an id is dropped; a body without an array of jobs gives no rows.
    """
    raw = F.col(body_col)
    body = F.when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"x":'), raw, F.lit("}")), "$.x")).otherwise(raw)
    rows = envelopes.select(*keep, body.alias("_body")).select(*keep, "_body", F.try_parse_json("_body").alias("_doc")).where("_doc is not null")
    jobs = rows.select(*keep, F.posexplode(locate_jobs(F.col("_doc"), F.col("_body"))).alias("position", "_job"))
    first = lambda field, read: F.coalesce(*(F.nullif(read(jsons.inside(F.col("_job"), k)), F.lit("")) for k in FIELD_ALIASES[field]), F.lit(""))
    out = jobs.select(*keep, "position", *(first(k, jsons.nested_of if k == "location" else jsons.rounded_of).alias(k) for k in FIELD_ALIASES), F.to_json("_job").alias("raw_json"))
    pay = text.salary(F.col("salary_raw"))
    return out.where("external_job_id <> ''").select("*", pay["currency"].alias("salary_currency"), pay["min"].alias("salary_min"), pay["max"].alias("salary_max"), times.any_time(F.col("posted_raw")).alias("posted_at")).drop("posted_raw")
