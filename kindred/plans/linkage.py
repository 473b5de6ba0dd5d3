"""The whole linkage: normalise, find candidates, build features, score, look at siblings, decide, write."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..functions.text import normalize_entities
from ..operators import blocking, collective, decision, features, metrics, model, populations
from ..sources.store import Store
from .profiles import PROFILES

CODES = ["legal_code_q", "legal_code_s", "state_code_q", "state_code_s"]
KEYS = ["rec", "s1", "label", "weight", "p", "p_mine"]
NAME_FAMILIES = "npqkgi"  # key families that look at names only
DEPTH, EXTRAS = 30, 5  # candidates by name alone that are looked at, and extra ones that a record gets


def own_columns(df: DataFrame) -> list:
    """The feature columns of a table of pairs: whatever the feature functions have left there."""
    return numeric_columns(df, KEYS)


def tf_columns(df: DataFrame) -> list:
    return [c for c in own_columns(df) if c.startswith("tf_")]


def candidates(s1: DataFrame, records: DataFrame, profile: dict, save, dense: DataFrame | None = None) -> DataFrame:
    """Pairs of every channel with scores. Records without an address are also sought by name alone, by keys and by n-grams:
    pairs that both find high become extras, and all n-gram pairs carry their scores (tf_). Without vectors the dense
    channel is empty and has its defaults."""
    keys, n = save(blocking.blocking_keys(s1), "keys"), s1.count()
    postings, norms = blocking.build_index(keys, n)
    sparse = blocking.block_search(save(blocking.blocking_keys(records), "record_keys"), save(postings, "postings"), save(norms, "norms"), profile["k"])
    if dense is None:
        dense = sparse.select("rec", "s1", F.lit(-1.0).alias("dense_score"), F.lit(99).alias("dense_rank")).limit(0)
    merged = save(blocking.merge_channels(sparse, dense), "merged")
    if not profile["tfidf"]:
        return merged.withColumn("extra_rank", F.lit(0))
    bare = records.where(~F.col("has_addr"))
    scope = lambda d: d.select(F.col("entity_id").alias("id"), F.col("country").alias("scope"), "name_norm")
    t = save(blocking.adaptive_cut(blocking.tfidf_search(scope(bare), scope(s1), blocking.variant_units("char3x_norm"), cut=blocking.CUT)), "tfidf")
    names = save(blocking.blocking_keys(blocking.name_only(s1), NAME_FAMILIES), "name_keys")
    postings, norms = blocking.build_index(names, n)
    asked = save(blocking.blocking_keys(blocking.name_only(bare), NAME_FAMILIES), "bare_keys")
    by_name = blocking.block_search(asked, save(postings, "name_postings"), norms, DEPTH)
    extras = blocking.rrf([(by_name, "sparse_rank"), (t, "rank")], merged, n=EXTRAS)
    return blocking.add_tfidf(blocking.add_extras(merged, extras), t)


def pair_features(s1: DataFrame, records: DataFrame, pairs: DataFrame, profile: dict) -> DataFrame:
    everyone = s1.unionByName(records)
    if profile["french"]:
        everyone = features.french_entities(everyone)
    f = features.string_features(features.retrieval_features(pairs), features.state_overlay(everyone), features.vocabulary(s1), profile["french"])
    if profile["code_dropout"]:
        f = model.code_dropout(f, CODES, profile["code_dropout"])
    return f


def specialist(f: DataFrame, scored: DataFrame, s1: DataFrame, records: DataFrame, profile: dict, save, train=None, rounds: int = 40) -> DataFrame:
    """`scored` with the pairs of records without an address scored by a model of their own, which also looks at n-gram scores,
    at a record's other candidates, at the first model's out-of-fold view and, by profile, at names as written; `scored`
    itself where there is nothing to learn from."""
    own = features.relative_features(f.where("q_has_addr = 0"), features.name_twins(s1))
    if profile["raw_names"]:
        own = features.raw_name_features(own, s1.unionByName(records))
    tf = tf_columns(own)
    if tf:
        own = own.withColumn("tf_missing", F.col("tf_score").isNull().cast("int")).fillna({"tf_score": 0.0, "tf_rank": 999, "tf_gap_best": 1.0, "tf_ratio": 0.0, "tf_n_close": 0, "tf_ties": 0})
    own = save(own, "noaddr")
    names = own_columns(own)
    learn = own if train is None else own.where(train)
    if learn.select("label").distinct().count() < 2:
        return scored
    # stage A sees each training record by models that haven't seen it, stage B learns from what they say
    first = save(model.out_of_fold(learn, names, folds=3, rounds=max(rounds // 5, 2), depth=3).withColumnRenamed("p", "p_a").select("rec", "s1", "p_a"), "stage_a")
    every = model.score(model.fit_gbt(learn, names, rounds=max(rounds // 5, 2), depth=3), own, names, "p_all")
    staged = save(every.join(first, ["rec", "s1"], "left").withColumn("p_a", F.coalesce("p_a", "p_all")).drop("p_all"), "staged")
    taught = staged if train is None else staged.where(train)
    better = model.score(model.fit_gbt(taught, [*names, "p_a"], rounds=max(rounds // 2, 2), depth=4), staged, [*names, "p_a"]).withColumn("has_addr", F.lit(False))
    return decision.replace_rows(scored, better.select(*scored.columns))


def chosen_rule(rt: DataFrame, truth: DataFrame, s1: DataFrame, profile: dict, orphan_share: float | None = None) -> dict:
    """The profile's rule, or one that does better on both halves of the records: tuned on one, confirmed on the other."""
    owned = rt.agg(F.count_if("owned"), F.count_if(~F.col("owned"))).first()
    weight = metrics.orphan_weight(orphan_share, owned[1], owned[0]) if orphan_share and all(owned) else 1.0
    return metrics.tuned_rule(rt, truth, s1, profile["rule"], metrics.rule_grid(), populations.halves("rec"), weight)


def link(sources: list, truth: DataFrame, profile: str = "default", save=None, train=None, tune_on=None, orphan_share: float | None = None, rounds: int = 40) -> dict:
    """sources: raw tables of S1, S2 and S3. truth: (s1, rec). train: condition on rec of the records that models learn from;
    tune_on: of those that the rule is chosen on (by default all that no model learned from). rounds: trees of the ranker, by
    which the other models are sized too. Returns the tables of each step; `save` writes a step and reads it again, by default in the cluster's shared folder."""
    p = PROFILES[profile]
    save = save or Store(truth.sparkSession, f"link-{profile}").save
    spread = lambda s: s.repartition("entity_id")  # noqa: E731 - a small file is one task, and normalising it much work
    s1, *rest = [save(normalize_entities(spread(s)), f"source{i + 1}") for i, s in enumerate(sources)]
    records = rest[0]
    for r in rest[1:]:
        records = records.unionByName(r)
    pairs = save(candidates(s1, records, p, save), "pairs")
    f = save(pair_features(s1, records, pairs, p).join(truth.withColumn("label", F.lit(1)), ["rec", "s1"], "left").fillna(0, ["label"]), "features")
    learn = f if train is None else f.where(train)
    if p["unseen_codes_to_unknown"]:
        known = learn.agg(*[F.collect_set(c).alias(c) for c in CODES]).first()  # codes are few: forms and states
        f = features.unseen_codes_to_unknown(f, {c: known[c] for c in CODES})
    names = [c for c in own_columns(f) if c not in tf_columns(f)]
    weak = model.fit_gbt(learn, names, rounds=max(rounds // 4, 2), depth=3)
    mined = save(model.mine_hard(model.score(weak, learn, names, "p_mine")), "mined")
    ranker = model.fit_gbt(mined, names, weight="weight", rounds=rounds)
    scored = save(model.score(ranker, f, names).withColumn("has_addr", F.col("q_has_addr") == 1).select("rec", "s1", "p", "label", "has_addr"), "scored")
    if p["specialist"]:
        scored = save(specialist(f, scored, s1, records, p, save, train, rounds), "scored_noaddr")
    second = collective.pass2_features(scored, s1.unionByName(records)).withColumnRenamed("p", "p_first")
    second = save(second, "second")
    again = own_columns(second)
    refit = model.fit_gbt(second if train is None else second.where(train), again, rounds=max(rounds // 2, 2), depth=4)
    final = save(model.score(refit, second, again), "final")
    rt = decision.record_table(final).join(records.select(F.col("entity_id").alias("rec"), "country"), "rec")
    rt = save(rt.join(truth.select("rec").distinct().withColumn("owned", F.lit(True)), "rec", "left").fillna(False, ["owned"]), "records")
    judged = tune_on if tune_on is not None else None if train is None else ~train
    rule = chosen_rule(rt if judged is None else rt.where(judged), truth, s1, p, orphan_share)
    seen = None
    if p["rule_unseen"]:  # countries that the models learned from; few
        taught = records.select(F.col("entity_id").alias("rec"), "country").join(learn.select("rec").distinct(), "rec", "left_semi")
        seen = [r["country"] for r in taught.select("country").distinct().collect()]
    decided = save(decision.decide(rt, rule, p["rule_unseen"], seen), "decided")
    links = decided.where("accept").select("rec", "s1")
    out = {"matches": decision.owner_lists(links, s1, "matched_entity_ids"), "candidates": decision.owner_lists(pairs, s1, "candidate_entity_ids")}
    models = {"ranker": (ranker, names), "second": (refit, again)}
    return {"s1": s1, "records": records, "pairs": pairs, "features": f, "scored": scored, "final": final, "rule": rule, "decided": decided, "links": links, "models": models, **out, "score": metrics.exact_f05(truth, links, s1)}


def leave_country_out(f: DataFrame, country: DataFrame, truth: DataFrame, s1: DataFrame, rule: dict, relative: bool = False, without: list = (), **options) -> DataFrame:
    """(country, how, entities, f05): for each country, mean F0.5 of its entities by a model that learned from all countries and
    by one that has never seen it, with a rule tuned on the others. f: labelled features; country: (rec, country). The
    continuous features can be made country-relative, and columns can be left out, such as codes. Countries are few."""
    rows = f.join(country, "rec")
    names = [c for c in own_columns(f) if c not in without and not c.startswith("tf_")]
    if relative:
        wide = [c for c, n in rows.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first().asDict().items() if n > 20]
        rows = features.country_percentile(rows, wide)
        names = [f"{c}_pct" if c in wide else c for c in names]
    owners = truth.select("rec").distinct().withColumn("owned", F.lit(True))
    out = None
    every = model.fit_gbt(rows, names, **options)
    for (held,) in sorted(map(tuple, country.select("country").distinct().collect())):
        rest = rows.where(F.col("country") != held)
        own = s1.where(F.col("country") == held)
        for how, fitted in (("seen", every), ("unseen", model.fit_gbt(rest, names, **options))):
            rt = lambda d: decision.record_table(model.score(fitted, d.select("rec", "s1", "label", (F.col("q_has_addr") == 1).alias("has_addr"), *names), names)).join(owners, "rec", "left").fillna(False, ["owned"])  # noqa: E731, B023
            tuned = metrics.tuned_rule(rt(rest), truth, s1, rule, metrics.rule_grid(), populations.halves("rec"))
            links = rt(rows.where(F.col("country") == held)).where(decision.accepted(tuned)).select("rec", "s1")
            part = metrics.exact_f05(truth, links, own).agg(F.lit(held).alias("country"), F.lit(how).alias("how"), F.count(F.lit(1)).alias("entities"), F.round(F.avg("f05"), 6).alias("f05"))
            out = part if out is None else out.unionByName(part)
    return out
