"""Document migration queries; nested results are flattened to text so that SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config.schemas import DOCUMENT
from claimloom.functions.text import document_kind as kind_of
from claimloom.operators import documents as migration
from claimloom.operators.lookups import lookup_first, lookup_first_in_array, resolve_children as resolve, update_from
from claimloom.plans import views
from claimloom.session import stored, work_path
from claimloom.sources.readers import read_documents
from claimloom.sources.sinks import write_documents

CREATED = "2024-01-01"


def joined(array: str, entry) -> Column:
    """Text of an array of structs, entries separated by ``;`` and null parts shown as ``-``."""
    return F.array_join(F.transform(array, entry), ";")


def shown(col: Column) -> Column:
    return F.coalesce(col, F.lit("-"))


def lookup_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("ID", "CarrierName")
    return migration.with_client(docs, views.clients(spark, sf_dir))


def lookup_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("ID", "CarrierName")
    return migration.with_prompt(docs, views.prompts(spark, sf_dir))


def lookup_array_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("ID")
    values = {"uniqueId": "DeclarationNumber"}
    return lookup_first_in_array(
        docs, "ID", views.declarations(spark, sf_dir), "DeclarationDocumentID", values, ["_id"]
    )


def document_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("ID", kind_of(F.col("DocumentType")).alias("kind"))


def split_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, payloads = migration.split_payload(views.documents(spark, sf_dir), CREATED)
    sizes = payloads.select("jsonId", F.length("JsonData").alias("size"))
    return docs.select("ID", "jsonId").join(sizes, "jsonId", "left").select("ID", "jsonId", "size")


def migrated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return migration.migrate_documents(
        views.documents(spark, sf_dir),
        views.clients(spark, sf_dir),
        views.policies(spark, sf_dir),
        views.declarations(spark, sf_dir),
        views.prompts(spark, sf_dir),
        created=CREATED,
    )


def flat(target: DataFrame) -> DataFrame:
    return target.select(
        "documentId", "uniqueId", "clientName", "clientID", "documentTag", "documentSubTag", "processStatus",
        "retryCount", "isActive", "jsonId", F.col("prompt.qnAPrompId").alias("promptId"),
        F.col("failure.reason").alias("reason"), F.size("failure.code").alias("n_codes"),
        F.col("formNumber.normalizedFormNumber").alias("form"), F.size("childDocumentIds").alias("n_children"),
    )


def to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(migrated(spark, sf_dir)[0])


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON and read back with their schema."""
    path = work_path(spark, "documents")
    write_documents(views.documents(spark, sf_dir), path)
    return read_documents(spark, path, DOCUMENT).select("ID", "DocumentType", "FormNumber", "RetryCount", F.length("JsonData").alias("size"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, untyped = migrated(spark, sf_dir)
    target = views.documents(spark, sf_dir).selectExpr("ID as documentId", "cast(null as string) as uniqueId")
    target = target.withColumn("metaData", F.lit(None).cast(migration.META_DATA))
    _, no_ids = migration.migrate_declarations(target, views.declarations(spark, sf_dir))
    return untyped.unionByName(no_ids)


def update_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declaration data on all documents it names; the last declaration wins."""
    target, _ = migration.migrate_declarations(migrated(spark, sf_dir)[0], views.declarations(spark, sf_dir))
    return target.select("documentId", "uniqueId", F.col("metaData.holderName").alias("holder"), F.col("metaData.startDate").alias("start"))


def update_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names set on the first turn of each conversation only."""
    turns = views.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("d"), F.col("conv_id").cast("string")).alias("documentId"), "turn", F.col("role").alias("tag")
    )
    values = {"tag": "HolderName"}
    declarations = views.declarations(spark, sf_dir).filter(F.col("DeclarationDocumentID").isNotNull())
    return update_from(turns, declarations, "documentId", "DeclarationDocumentID", values, ["_id"], first_only=["turn"])


def resolve_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("ID", "DocumentPath", "FormNumber")
    child = F.struct("ID", "DocumentPath")
    declarations = views.declarations(spark, sf_dir).select("_id", "AppliedEndorsement")
    resolved, _ = resolve(declarations, "_id", "AppliedEndorsement", docs, "ID", child, "children")
    return resolved.select("_id", joined("children", lambda c: F.concat_ws("|", c["ID"], c["DocumentPath"])).alias("children"))


def child_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children and form numbers of the declaration documents."""
    target, _ = migration.update_child_documents(
        stored(migrated(spark, sf_dir)[0], "migrated"), views.policies(spark, sf_dir), views.declarations(spark, sf_dir)
    )
    return target.select(
        "documentId",
        joined("childDocumentIds", lambda c: F.concat_ws("|", c["documentId"], c["documentTag"], c["filePath"])).alias("children"),
        joined("extractedFormNumbers", lambda f: F.concat_ws("|", f["formNumber"], f["normalizedFormNumber"])).alias("forms"),
    )


def child_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, misses = migration.update_child_documents(
        stored(migrated(spark, sf_dir)[0], "migrated"), views.policies(spark, sf_dir), views.declarations(spark, sf_dir)
    )
    return misses.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


def merged_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = views.documents(spark, sf_dir).withColumn("turn", F.lit(None).cast("bigint"))
    return migration.merge_parts(docs.unionByName(views.parts(spark, sf_dir)), order=["turn"])


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of merged records, one row each."""
    headers, parts = merged_parts(spark, sf_dir)
    rows = parts.join(headers.select("documentId", "documentTag", "clientName"), "documentId")
    return rows.select("documentId", "documentTag", "clientName", "turn", F.col("part.documentId").alias("part"), F.col("part.formNumber.formNumber").alias("form"))


def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the turns of the conversation of the same number as parts."""
    merged = migration.nested_parts(*merged_parts(spark, sf_dir), order=["turn"])
    entry = joined("splitDocumentList", lambda p: F.concat_ws("|", p["documentId"], p["documentTag"], p["processStatus"], p["formNumber"]["formNumber"]))
    return merged.select("documentId", "documentTag", "clientName", "documentName", "processStatus", entry.alias("parts"))


def leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as lease documents."""
    number = F.col("page_id").cast("string")
    columns = {
        "ID": F.concat(F.lit("l"), number),
        "DocumentType": F.lit("Lease"),
        "CarrierName": F.concat(F.lit("Carrier src"), F.length("url").cast("string")),
        "DocumentPath": F.col("url"),
        "PolicyName": F.concat(F.lit("Lease "), number),
        "JsonData": F.col("html"),
    }
    typed = views.documents(spark, sf_dir).schema
    return views.table(spark, sf_dir, "pages").select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in typed]
    )


def migrate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy documents and lease documents in one target."""
    lease_docs, _, _ = migration.migrate_leases(
        leases(spark, sf_dir), views.clients(spark, sf_dir), views.prompts(spark, sf_dir), CREATED
    )
    return flat(migrated(spark, sf_dir)[0].unionByName(lease_docs))


def all_stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    collections = (leases, views.clients, views.policies, views.declarations, views.prompts)
    docs = views.documents(spark, sf_dir).unionByName(views.parts(spark, sf_dir).drop("turn"))
    return migration.migrate_all(docs, *[read(spark, sf_dir) for read in collections], created=CREATED)


def migrated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the results of the full migration, with parts in its input."""
    stages = all_stages(spark, sf_dir)
    is_part = F.col("documentId").contains("_")
    rows = [
        stages["documents"].filter(~is_part).agg(F.lit("documents").alias("part"), F.count(F.lit(1)).alias("n"), F.count("jsonId").alias("n_payloads")),
        *[stages[name].agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("n_payloads")) for name in ("merged", "parts")],
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def whole_migration(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    collections = (leases, views.clients, views.policies, views.declarations, views.prompts)
    frames = [read(spark, sf_dir) for read in (views.documents, *collections)]
    return migration.migrate_all(*frames, created=CREATED)


def migrated_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads that the full migration stores apart, of documents and leases."""
    return whole_migration(spark, sf_dir)["payloads"].select(
        "jsonId", F.sha2("JsonData", 256).alias("digest"), F.length("JsonData").cast("bigint").alias("size"), F.date_format("CreatedDate", "yyyy-MM-dd").alias("created")
    )


def migrated_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages of the full migration reject, per stage and reason."""
    rejects = whole_migration(spark, sf_dir)["rejects"]
    return rejects.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


def migrate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order: documents with declaration data and children, leases without."""
    return whole_migration(spark, sf_dir)["documents"].select(
        "documentId",
        "uniqueId",
        "documentSubTag",
        F.col("metaData.holderName").alias("holder"),
        joined("childDocumentIds", lambda c: F.concat_ws("|", c["documentId"], c["documentTag"], c["filePath"])).alias("children"),
        joined("extractedFormNumbers", lambda f: F.concat_ws("|", f["formNumber"], f["normalizedFormNumber"])).alias("forms"),
    )


QUERIES = {
    "lookup_scalar": lookup_scalar,
    "lookup_null_safe": lookup_null_safe,
    "lookup_array_key": lookup_array_key,
    "document_kind": document_kind,
    "split_payload": split_payload,
    "to_document": to_document,
    "document_files": document_files,
    "rejects": rejects,
    "update_many": update_many,
    "update_first": update_first,
    "resolve_children": resolve_children,
    "child_documents": child_documents,
    "child_misses": child_misses,
    "merge_parts": merge_parts,
    "part_rows": part_rows,
    "migrated_counts": migrated_counts,
    "migrate_union": migrate_union,
    "migrate_all": migrate_all,
    "migrated_payloads": migrated_payloads,
    "migrated_rejects": migrated_rejects,
}


DOCS = f"docs as ({views.documents_sql()})"
POLICIES = f"policies as ({views.policies_sql()})"
DECS = f"decs as ({views.declarations_sql()})"
CLIENTS = f"clients as ({views.CLIENTS_SQL})"
PROMPTS = f"prompts as ({views.PROMPTS_SQL})"
DEC_IDS = 'dec_ids as (select unnest("DeclarationDocumentID") as ref, d.* from decs d)'
KIND = """case when lower("DocumentType") like '%base%' then 'base' when lower("DocumentType") like '%endo%' then 'endo'
  when lower("DocumentType") like '%dec%' then 'dec' end"""
JSON_ID = """case when trim("JsonData") not in ('', '{}', '[]', 'null') then sha256("ID" || '|' || "JsonData") end"""
TARGET = f"""{DOCS}, {POLICIES}, {DECS}, {CLIENTS}, {PROMPTS}, {DEC_IDS},
names as (select 'base' as kind, "BasePolicyDocumentID" as ref, "PolicyName", _id from policies
  union all select 'endo', unnest("EndorsementDocumentID"), "PolicyName", _id from policies
  union all select 'dec', ref, "PolicyName", _id from dec_ids),
first_names as (select kind, ref, arg_min("PolicyName", _id) as name from names group by kind, ref),
first_clients as (select "ClientName", min(_id) as client from clients group by 1),
first_prompts as (select "CarrierName", min("PromptID") as prompt from prompts where "PolicyName" is null group by 1),
first_decs as (select ref, arg_min("DeclarationNumber", _id) as number from dec_ids group by ref),
target as (select d."ID" as "documentId", f.number as "uniqueId", d."CarrierName" as "clientName", c.client as "clientID",
  "DocumentType" as "documentTag", n.name as "documentSubTag", "Status" as "processStatus", "DocumentPath" as "filePath",
  coalesce("RetryCount", 0) as "retryCount", true as "isActive", {JSON_ID} as "jsonId", p.prompt as "promptId",
  "FailureReason" as reason, 0 as n_codes, "FormNumber", "NormalizedFormNumber" as form, 0 as n_children
  from docs d left join first_decs f on f.ref = d."ID" left join first_names n on n.ref = d."ID" and n.kind = {KIND}
  left join first_clients c on c."ClientName" = d."CarrierName" left join first_prompts p on p."CarrierName" = d."CarrierName"
  where d."DocumentType" is not null)"""
FLAT = """"documentId", "uniqueId", "clientName", "clientID", "documentTag", "documentSubTag", "processStatus", "retryCount",
  "isActive", "jsonId", "promptId", reason, n_codes, form, n_children"""
LINKED = """first_dec as (select * from decs qualify row_number() over (partition by "CarrierName", "PolicyName" order by _id) = 1),
linked as (select p._id as policy_id, d."DeclarationDocumentID" as dec_ids, d."AppliedEndorsement" as applied,
    list_concat([p."BasePolicyDocumentID"], p."EndorsementDocumentID") as form_ids
  from policies p join first_dec d on p."CarrierName" is not distinct from d."CarrierName"
    and p."PolicyName" is not distinct from d."PolicyName" where len(d."DeclarationDocumentID") > 0)"""
WINNERS = """winners as (select * from (select unnest(dec_ids) as dec_id, policy_id, applied, form_ids from linked)
  qualify row_number() over (partition by dec_id order by policy_id desc) = 1),
applied_ids as (select dec_id, unnest(applied) as ref, generate_subscripts(applied, 1) as pos from winners),
children as (select dec_id, string_agg(concat_ws('|', t."documentId", t."documentTag", t."filePath"), ';' order by pos) as children
  from applied_ids a join target t on t."documentId" = a.ref group by dec_id),
form_entries as (select dec_id, unnest(form_ids) as ref, generate_subscripts(form_ids, 1) as pos from winners),
forms as (select dec_id, string_agg(concat_ws('|', t."FormNumber", t.form), ';' order by pos) as forms
  from form_entries a join target t on t."documentId" = a.ref where length(t."FormNumber") > 0 group by dec_id)"""
MISSES = """a as (select unnest(applied) as ref from linked), f as (select unnest(form_ids) as ref from linked),
misses as (select 'applied endorsement not found' as reason, a.ref from a where ref not in (select "documentId" from target)
  union all select 'form number not found', f.ref from f
    where ref not in (select "documentId" from target where length("FormNumber") > 0)
  union all select 'no applied endorsements', policy_id from linked where applied is null)"""

ORACLE = {
    "lookup_scalar": f"""with {DOCS}, {CLIENTS} select "ID", "CarrierName", (select min(_id) from clients where "ClientName" = "CarrierName")
        as "clientID" from docs""",
    "lookup_null_safe": f"""with {DOCS}, {PROMPTS} select "ID", "CarrierName", (select min("PromptID") from prompts p
        where p."PolicyName" is null and p."CarrierName" is not distinct from d."CarrierName") as "promptId" from docs d""",
    "lookup_array_key": f"""with {DOCS}, {DECS}, {DEC_IDS}, f as (select ref, arg_min("DeclarationNumber", _id) as number from dec_ids group by ref)
        select "ID", number as "uniqueId" from docs left join f on ref = "ID\"""",
    "document_kind": f'with {DOCS} select "ID", {KIND} as kind from docs',
    "split_payload": f"""with {DOCS} select "ID", {JSON_ID} as "jsonId", case when {JSON_ID} is not null then cast(length("JsonData") as integer) end as size
        from docs""",
    "to_document": f"with {TARGET} select {FLAT} from target",
    "document_files": f"""with {DOCS} select "ID", "DocumentType", "FormNumber", "RetryCount",
        cast(length("JsonData") as integer) as size from docs""",
    "rejects": f"""with {DOCS}, {DECS} select 'Documents' as stage, "ID" as id, 'no document type' as reason from docs
        where "DocumentType" is null union all select 'Declaration', _id, 'no declaration documents' from decs
        where "DeclarationDocumentID" is null""",
    "update_many": f"""with {TARGET}, last_dec as (select ref, arg_max(struct_pack(number := "DeclarationNumber", holder := "HolderName",
          start := "StartDate"), _id) as d from dec_ids group by ref)
        select "documentId", case when l.ref is null then "uniqueId" else l.d.number end as "uniqueId", l.d.holder as holder,
          l.d.start as start from target left join last_dec l on l.ref = "documentId\"""",
    "update_first": f"""with {DECS}, {DEC_IDS}, last_dec as (select ref, arg_max("HolderName", _id) as holder from dec_ids group by ref),
        turns as (select 'd' || conv_id as "documentId", turn, role, min(turn) over (partition by conv_id) as first_turn from conversations)
        select "documentId", turn, case when turn = first_turn and holder is not null then holder else role end as tag
        from turns left join last_dec on ref = "documentId\"""",
    "resolve_children": f"""with {DOCS}, {DECS}, ids as (select _id, unnest("AppliedEndorsement") as ref,
          generate_subscripts("AppliedEndorsement", 1) as pos from decs),
        found as (select i._id, string_agg("ID" || '|' || "DocumentPath", ';' order by pos) as children from ids i join docs on "ID" = ref group by i._id)
        select d._id, coalesce(children, '') as children from decs d left join found using (_id)""",
    "child_documents": f"""with {TARGET}, {LINKED}, {WINNERS} select "documentId", coalesce(children, '') as children,
        coalesce(forms, '') as forms from target left join children c on c.dec_id = "documentId"
        left join forms f on f.dec_id = "documentId\"""",
    "migrated_payloads": f"""with {DOCS}, stored as (select {JSON_ID} as "jsonId", "JsonData" as payload from docs
          union all select sha256('l' || page_id || '|' || html), html from pages where trim(html) not in ('', '{{}}', '[]', 'null'))
        select "jsonId", sha256(payload) as digest, length(payload) as size, '{CREATED}' as created from stored where "jsonId" is not null""",
    "migrated_rejects": f"""with {TARGET}, {LINKED}, {MISSES}, all_stages as (
          select 'Documents' as stage, 'no document type' as reason, "ID" as id from docs where "DocumentType" is null
          union all select 'Declaration', 'no declaration documents', _id from decs where "DeclarationDocumentID" is null
          union all select 'Child_documents', reason, ref from misses)
        select stage, reason, count(*) as n, count(distinct id) as ids from all_stages group by stage, reason""",
    "child_misses": f"""with {TARGET}, {LINKED}, {MISSES}
        select reason, count(*) as n, count(distinct ref) as ids from misses group by reason""",
    "part_rows": f"""with {DOCS} select 'd' || conv_id as "documentId", 'Merged Document' as "documentTag", "CarrierName" as "clientName", turn,
        'd' || conv_id || '_' || turn as part, 'T' || turn as form from conversations join docs on "ID" = 'd' || conv_id""",
    "migrated_counts": f"""with {TARGET}, {LINKED} select 'documents' as part, (select count(*) from target) + (select count(*) from pages) as n,
          (select count("jsonId") from target) + (select count(*) from pages where length(html) > 0) as n_payloads
        union all select 'merged', count(distinct "ID"), null from docs join conversations on "ID" = 'd' || conv_id
        union all select 'parts', count(*), null from docs join conversations on "ID" = 'd' || conv_id""",
    "merge_parts": f"""with {DOCS}, parts as (select 'd' || conv_id as base, turn,
          concat_ws('|', 'd' || conv_id || '_' || turn, role, case when length(text) > 100 then 'Processed' else 'Failed' end, 'T' || turn) as part
          from conversations), lists as (select base, string_agg(part, ';' order by turn) as parts from parts group by base)
        select "ID" as "documentId", 'Merged Document' as "documentTag", "CarrierName" as "clientName", "DocumentName" as "documentName",
          "Status" as "processStatus", parts from docs join lists on base = "ID\"""",
    "migrate_union": f"""with {TARGET} select {FLAT} from target union all
        select 'l' || page_id, null, 'Carrier src' || length(url), c.client, 'Lease', 'Lease ' || page_id, null, 0, true,
          sha256('l' || page_id || '|' || html), p.prompt, null, 0, null, 0 from pages
        left join first_clients c on c."ClientName" = 'Carrier src' || length(url)
        left join first_prompts p on p."CarrierName" = 'Carrier src' || length(url)""",
    "migrate_all": f"""with {TARGET}, {LINKED}, {WINNERS}, last_dec as (select ref, arg_max(struct_pack(number := "DeclarationNumber",
          holder := "HolderName"), _id) as d from dec_ids group by ref)
        select "documentId", case when l.ref is null then "uniqueId" else l.d.number end as "uniqueId", "documentSubTag",
          l.d.holder as holder, coalesce(children, '') as children, coalesce(forms, '') as forms from target
          left join last_dec l on l.ref = "documentId" left join children c on c.dec_id = "documentId"
          left join forms f on f.dec_id = "documentId"
        union all select 'l' || page_id, null, 'Lease ' || page_id, null, '', '' from pages""",
}
