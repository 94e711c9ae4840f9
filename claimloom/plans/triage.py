"""Feature, model and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config.schemas import TEXT_CLAIM
from claimloom.config.vocabulary import CODE_VOCABULARY, TEXT_VOCABULARY
from claimloom.functions import text
from claimloom.operators import features, metrics, models, series
from claimloom.operators.boosting import Setting, load_boosted, search_boosted, train_boosted
from claimloom.plans import views
from claimloom.session import stored, work_path
from claimloom.sources.readers import read_training

TEXT_COLUMNS = list(TEXT_VOCABULARY)
CODE_COLUMNS = list(CODE_VOCABULARY)


def one_hot_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return features.one_hot_learned(events, ["event_type"], keep=["event_id"])


def one_hot_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = features.normalise_columns(views.claims(spark, sf_dir), TEXT_COLUMNS)
    return features.one_hot_fixed(claims, TEXT_VOCABULARY, keep=["claim_id"], sep=" ")


def one_hot_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = features.fill_na(views.coded_claims(spark, sf_dir))
    return features.one_hot_fixed(claims, CODE_VOCABULARY, keep=["event_id"])


def feature_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.feature_tokens(views.claims(spark, sf_dir), ["Status", "Rooms", "Engagement"], sep=" ")
    return tokens.select("claim_id", "token")


def normalise_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["Status", "Materials", "Rooms"]
    return features.normalise_columns(views.claims(spark, sf_dir), columns).select("claim_id", *columns)


def training_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims as CSV files of a folder, read back as training rows."""
    path = work_path(spark, "training")
    claims = views.claims(spark, sf_dir).select("claim_id", *TEXT_COLUMNS, "labels")
    claims.write.options(header=True, escape='"').csv(path)
    return read_training(spark, path, f"claim_id bigint, {TEXT_CLAIM}, labels string")


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = features.label_index(views.claims(spark, sf_dir).select("claim_id", "labels"), "labels")
    return coded


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = views.claims(spark, sf_dir).select("claim_id", "labels")
    return features.hash_split(claims, ["claim_id"], test=0.3)


def one_hot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned encoding of two open-ended columns in long form."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return features.one_hot_long(orders, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"])


def stratified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of every row of a stratified split."""
    return features.stratified_split(views.claims(spark, sf_dir).select("claim_id", "labels"), "labels", ["claim_id"])


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and test rows per class; the share is exact in every class."""
    split = features.stratified_split(views.claims(spark, sf_dir).select("claim_id", "labels"), "labels", ["claim_id"])
    return split.groupBy("labels").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))


MULTICLASS = Setting(models.BOOSTING["maxDepth"], models.BOOSTING["stepSize"], models.BOOSTING["maxIter"], seed=models.BOOSTING["seed"])


def triage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on one side, for all classes jointly, stored, loaded and used on the other side."""
    claims = features.normalise_columns(views.claims(spark, sf_dir), TEXT_COLUMNS)
    split = stored(features.stratified_split(claims, "labels", ["claim_id"]), "split")
    model = train_boosted(split.filter(~F.col("is_test")), TEXT_COLUMNS, "labels", MULTICLASS, keys=["claim_id"])
    path = work_path(spark, "model")
    model.save(spark, path)
    return load_boosted(spark, path).score(split.filter("is_test"), ["claim_id", "labels"])


def triage_score_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every scored claim: whether its confidence is a percentage with two decimals, above that of a guess,
    and whether its class is one of the training's."""
    scored = triage_score(spark, sf_dir)
    classes = stored(views.claims(spark, sf_dir).select(F.col("labels").alias("recommendedServiceCode")).distinct(), "classes")
    known = scored.join(classes.withColumn("known_class", F.lit(True)), "recommendedServiceCode", "left")
    percent = F.col("confidenceScore").rlike(r"^[0-9]{1,3}\.[0-9]{2}$") & F.col("confidenceScore").cast("double").between(20, 100)
    return known.select("claim_id", "labels", percent.alias("is_percentage"), F.coalesce("known_class", F.lit(False)).alias("known_class"))


def triage_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class report of the scored test side."""
    return metrics.class_report(triage_score(spark, sf_dir), "labels", "recommendedServiceCode")


def repeat_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded claims with two classes, which depend on the answers."""
    hail = (F.col("PerilTypeID") == "HAIL") & F.col("Status").isin("CSLS", "CSLT")
    return views.coded_claims(spark, sf_dir).withColumn("labels", F.when(hail, "yes").otherwise("no"))


def triage_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = features.hash_split(repeat_claims(spark, sf_dir), ["event_id"], test=0.3)
    model = models.train_binary(split.filter(~F.col("is_test")), CODE_COLUMNS, "labels", clean=False, keys=["event_id"])
    return models.score(split.filter("is_test"), model, ["event_id", "labels"])


# points of FULL_GRID; the numbers of rounds are prefixes of one fit
GRID = {
    "maxDepth": [2, 3],
    "stepSize": [0.1],
    "maxIter": [50, 100],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8"],
}


def searched(spark: SparkSession, sf_dir: str):
    """Rows with their side, the results of the search over the training side, and its best model."""
    split = stored(features.hash_split(repeat_claims(spark, sf_dir), ["event_id"], test=0.3), "split")
    return split, *search_boosted(split.filter(~F.col("is_test")), CODE_COLUMNS, "labels", ["event_id"], GRID)


def triage_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and right answers of every grid point and fold."""
    _, results, _ = searched(spark, sf_dir)
    rows = [(*[str(point[name]) for name in GRID], fold, n, right) for point, fold, n, right in results]
    return spark.createDataFrame(rows, ", ".join([f"{name} string" for name in GRID] + ["fold int", "n bigint", "n_right bigint"]))


def triage_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best grid point's answers on the held-out side: rows and right answers of each class."""
    split, _, best = searched(spark, sf_dir)
    scored = best.score(split.filter("is_test"), ["event_id", "labels"])
    right = F.count_if(F.col("labels") == F.col("recommendedServiceCode"))
    return scored.groupBy("labels").agg(F.count(F.lit(1)).alias("n"), right.alias("n_right"))


def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = views.daily_demand(spark, sf_dir).select("item", "day", "demand", "promo")
    return series.demand_features(daily, "item", "day", "demand", holidays=["01-01", "12-25"])


def demand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven features; discounts and taxes stand in for the two weather columns."""
    rows = series.demand_features(views.daily_demand(spark, sf_dir), "item", "day", "demand", holidays=["01-01", "12-25"])
    return rows.select(
        "item",
        "day",
        F.col("discounts").cast("double").alias("average_temprature"),
        F.col("taxes").cast("double").alias("rainfall"),
        "weekend",
        "holiday",
        (F.col("sales").cast("double") / F.col("demand").cast("double")).alias("price_per_kg"),
        "promo",
        F.col("previous_days_demand").cast("double").alias("previous_days_demand"),
        F.col("demand").cast("double").alias("demand"),
    ).filter(F.col("previous_days_demand").isNotNull())


def demand_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = stored(features.hash_split(demand_rows(spark, sf_dir), ["item", "day"], test=0.3), "split")
    model = models.train_demand(split.filter(~F.col("is_test")), models.DEMAND_COLUMNS, "demand", keys=["item", "day"])
    return metrics.regression_metrics(model.transform(split.filter("is_test")), "demand", "prediction")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's demand as prediction, per item."""
    rows = demand_features(spark, sf_dir).filter(F.col("previous_days_demand").isNotNull())
    result = metrics.regression_metrics(rows, "demand", "previous_days_demand", by=["item"])
    return result.select("item", "n", *[F.round(c, 6).alias(c) for c in ("mae", "mse", "rmse", "r2")])


def guessed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status against a rule on the price, which gives no answer or an unknown class for some."""
    price = F.col("o_totalprice")
    guess = F.when(price < 100000, "F").when(price < 300000, "O").when(price < 400000, "P").when(price < 420000, "X")
    return views.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", guess.alias("guess"))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(guessed_status(spark, sf_dir), "o_orderstatus", "guess", by=["o_orderpriority"])


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(guessed_status(spark, sf_dir), "o_orderstatus", "guess", ["F", "O", "P"])


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_report(guessed_status(spark, sf_dir), "o_orderstatus", "guess")


QUERIES = {
    "one_hot_learned": one_hot_learned,
    "one_hot_fixed": one_hot_fixed,
    "one_hot_coded": one_hot_coded,
    "feature_tokens": feature_tokens,
    "normalise_category": normalise_category,
    "training_files": training_files,
    "label_index": label_index,
    "one_hot_long": one_hot_long,
    "hash_split": hash_split,
    "stratified_rows": stratified_rows,
    "stratified_split": stratified_split,
    "triage_score": triage_score,
    "triage_score_form": triage_score_form,
    "triage_multiclass": triage_multiclass,
    "triage_binary": triage_binary,
    "triage_grid": triage_grid,
    "triage_holdout": triage_holdout,
    "demand_features": demand_features,
    "demand_forest": demand_forest,
    "regression_metrics": regression_metrics,
    "accuracy": accuracy,
    "confusion_matrix": confusion_matrix,
    "class_report": class_report,
}


def clean_sql(col: str) -> str:
    return f"""regexp_replace(case {col} when 'no longer leaking, wet <1 day' then 'no longer leaking, wet less than 1 day'
      when 'no longer leaking, wet >1 day' then 'no longer leaking, wet more than 1 day' else {col} end, '[^0-9a-zA-Z ]', ' ', 'g')"""


def flags_sql(vocabulary: dict[str, list[str]], sep: str) -> str:
    return ", ".join(
        f"""case when "{c}" = '{v}' then 1 else 0 end as "{c}{sep}{v}\"""" for c, answers in vocabulary.items() for v in answers
    )


CLAIMS_SQL = f"claims as ({views.claims_sql()})"
DEMAND_SQL = """daily as (select p_brand as item, cast(l_shipdate as date) as day, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as demand,
  max(case when p_type = 'PROMO' then 1 else 0 end) as promo from lineitem join part on l_partkey = p_partkey group by all),
rows as (select item, day, demand, promo, cast(dayofweek(day) in (0, 6) as bigint) as weekend,
  cast(strftime(day, '%m-%d') in ('01-01', '12-25') as integer) as holiday,
  lag(demand) over (partition by item order by day) as previous_days_demand from daily)"""
GUESS_SQL = """guesses as (select o_orderpriority, o_orderstatus,
  case when o_totalprice < 100000 then 'F' when o_totalprice < 300000 then 'O'
    when o_totalprice < 400000 then 'P' when o_totalprice < 420000 then 'X' end as guess from orders)"""

ORACLE = {
    "one_hot_learned": "select event_id, "
    + ", ".join(
        f"cast(coalesce(nullif(event_type, 'error'), 'NA') = '{v}' as integer) as \"event_type_{v}\""
        for v in ("NA", "click", "purchase", "signup", "view")
    )
    + " from events",
    "one_hot_fixed": f"""with {CLAIMS_SQL}, cleaned as (select claim_id, {", ".join(f'{clean_sql(c)} as "{c}"' for c in TEXT_COLUMNS)}
        from claims) select claim_id, {flags_sql(TEXT_VOCABULARY, " ")} from cleaned""",
    "one_hot_coded": f"""with claims as ({views.coded_claims_sql()}),
        filled as (select event_id, {", ".join(f'''coalesce("{c}", 'NA') as "{c}"''' for c in CODE_COLUMNS)} from claims)
        select event_id, {flags_sql(CODE_VOCABULARY, "_")} from filled""",
    "feature_tokens": f"with {CLAIMS_SQL} "
    + " union all ".join(
        f"""select claim_id, '{c} ' || "{c}" as token from claims where "{c}" is not null""" for c in ("Status", "Rooms", "Engagement")
    ),
    "normalise_category": f"""with {CLAIMS_SQL} select claim_id, {", ".join(f'{clean_sql(c)} as "{c}"' for c in ("Status", "Materials", "Rooms"))}
        from claims""",
    "training_files": f"""with {CLAIMS_SQL} select * from claims""",
    "label_index": f"""with {CLAIMS_SQL} select claim_id, labels, cast(dense_rank() over (order by labels) - 1 as integer) as label_id
        from claims""",
    "one_hot_long": """with known as (select o_orderkey, 0 as col, 'o_orderstatus' as name, case when o_orderstatus = 'P' then 'NA' else o_orderstatus end as answer
          from orders union all select o_orderkey, 1, 'o_orderpriority', o_orderpriority from orders),
        numbered as (select col, answer, row_number() over (order by col, answer) - 1 as position from (select distinct col, answer from known))
        select o_orderkey, name || '_' || answer as feature, position from known join numbered using (col, answer)""",
    "hash_split": f"""with {CLAIMS_SQL} select claim_id, labels,
        ('0x' || substr(md5('42|' || claim_id), 1, 15))::bigint / 1152921504606846976.0 < 0.3 as is_test from claims""",
    # the labels follow a rule on the answers, which a right search finds: all held-out answers are right
    "triage_holdout": f"""with claims as ({views.coded_claims_sql()}), labelled as (select event_id,
          case when "PerilTypeID" = 'HAIL' and "Status" in ('CSLS', 'CSLT') then 'yes' else 'no' end as labels from claims)
        select labels, count(*) as n, count(*) as n_right from labelled
        where ('0x' || substr(md5('42|' || event_id), 1, 15))::bigint / 1152921504606846976.0 < 0.3 group by labels""",
    "triage_grid": """with hashed as (select ('0x' || substr(md5('42|' || event_id), 1, 15))::bigint as h from events),
        folds as (select cast(h % 3 as integer) as fold, count(*) as n from hashed where h / 1152921504606846976.0 >= 0.3 group by 1)
        select d as "maxDepth", '0.1' as "stepSize", r as "maxIter", s as "subsamplingRate", '0.8' as "featureSubsetStrategy", fold, n, n as n_right
        from folds, unnest(['2', '3']) as a(d), unnest(['50', '100']) as b(r), unnest(['0.8', '1.0']) as c(s)""",
    "triage_score_form": f"""with {CLAIMS_SQL}, hashed as (select claim_id, labels, ('0x' || substr(md5('42|' || claim_id), 1, 15))::bigint as h from claims),
        sides as (select *, row_number() over (partition by labels order by h, claim_id) <= round(count(*) over (partition by labels) * 0.25) as is_test
          from hashed)
        select claim_id, labels, true as is_percentage, true as known_class from sides where is_test""",
    "stratified_rows": f"""with {CLAIMS_SQL}, hashed as (select claim_id, labels, ('0x' || substr(md5('42|' || claim_id), 1, 15))::bigint as h from claims)
        select claim_id, labels, row_number() over (partition by labels order by h, claim_id)
          <= round(count(*) over (partition by labels) * 0.25) as is_test from hashed""",
    "stratified_split": f"""with {CLAIMS_SQL} select labels, count(*) as n, cast(round(count(*) * 0.25) as bigint) as n_test
        from claims group by labels""",
    "demand_features": f"with {DEMAND_SQL} select * from rows",
    "regression_metrics": f"""with {DEMAND_SQL}, sums as (select item, count(*) as n,
        cast(sum(abs(demand - previous_days_demand)) as double) as a, var_pop(demand) as v,
        cast(sum((demand - previous_days_demand) * (demand - previous_days_demand)) as double) as s
        from rows where previous_days_demand is not null group by item)
        select item, n, round(a / n, 6) as mae, round(s / n, 6) as mse, round(sqrt(s / n), 6) as rmse, round(1 - s / n / v, 6) as r2
        from sums""",
    "accuracy": f"""with {GUESS_SQL} select o_orderpriority, avg(cast(coalesce(o_orderstatus = guess, false) as integer)) as accuracy from guesses
        group by all""",
    "confusion_matrix": f"""with {GUESS_SQL} select o_orderstatus as label, count(*) filter (guess = 'F') as "predicted_F",
        count(*) filter (guess = 'O') as "predicted_O", count(*) filter (guess = 'P') as "predicted_P",
        count(*) filter (guess = 'X' or guess is null) as predicted_other from guesses group by all""",
    "class_report": f"""with {GUESS_SQL}, classes as (select unnest(['F', 'O', 'P', 'X']) as class),
        c as (select class, (select count(*) from guesses where o_orderstatus = class) as support,
          (select count(*) from guesses where guess = class) as predicted,
          (select count(*) from guesses where guess = class and o_orderstatus = class) as hits from classes)
        select class, coalesce(hits / nullif(predicted, 0), 0) as "precision", coalesce(hits / nullif(support, 0), 0) as recall, 2.0 * hits / (predicted + support) as f1, support from c""",
}
