"""Document migration: flat source documents to nested target records, by joins.

The stages run in the order documents, declarations, child documents, merged documents, leases.
Each one returns its result and the rejected rows ``(stage, id, reason)``. Where several source
rows match, the smallest id wins; where several rows update one record, the largest id wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config.schemas import CHILD_DOCUMENT, FORM_NUMBER, META_DATA, SPLIT_DOCUMENT
from claimloom.functions.text import base_id, document_kind
from claimloom.operators.curate import split_valid
from claimloom.operators.lookups import (
    apply_updates,
    array_hits,
    exploded_ids,
    first_per_key,
    lookup_first,
    listed_hits,
    tie_break,
    update_from,
)
from claimloom.session import stored

USE_CASE = "policy lookup"
MERGED_TAG = "Merged Document"
RECORD_ORDER = ["filePath", "jsonId"]  # which record of an id counts as the first one

TARGET_COLUMNS = [
    "useCase", "userId", "uniqueId", "documentId", "prompt", "documentName", "clientName", "clientID", "documentTag",
    "documentSubTag", "filePath", "declarationType", "processStatus", "adobeExtractPath", "uploadDate",
    "processedDate", "policyStatus", "retryCount", "failure", "formNumber", "extractedFormNumbers", "isDelete",
    "isActive", "jsonId", "metaData", "childDocumentIds",
]


def null_text() -> Column:
    return F.lit(None).cast("string")


def payload_id(doc_id: Column, payload: Column) -> Column:
    """Id of a stored payload, the same on every run; null for a missing or empty payload."""
    empty = payload.isNull() | F.trim(payload).isin("", "{}", "[]", "null")
    return F.when(~empty, F.sha2(F.concat_ws("|", doc_id, payload), 256))


def split_payload(docs: DataFrame, created: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents that point to their payload by ``jsonId``, and the payloads stored apart."""
    pointed = docs.withColumn("jsonId", payload_id(F.col("ID"), F.col("JsonData")))
    stamp = F.lit(created).cast("timestamp") if created else F.current_timestamp()
    payloads = pointed.filter(F.col("jsonId").isNotNull()).select("jsonId", "JsonData", stamp.alias("CreatedDate"))
    return pointed.drop("JsonData"), payloads


def form_number() -> Column:
    return F.struct(F.col("FormNumber").alias("formNumber"), F.col("NormalizedFormNumber").alias("normalizedFormNumber"))


def failure() -> Column:
    codes = F.coalesce("FailureStatusCode", F.array().cast("array<string>"))
    return F.struct(F.col("FailureReason").alias("reason"), codes.alias("code"))


def to_document(docs: DataFrame) -> DataFrame:
    """Nested target record with defaults, from documents with looked-up ids."""
    prompt = F.struct(
        F.col("promptId").alias("qnAPrompId"),
        null_text().alias("globalComparisonPromptId"),
        null_text().alias("globalQnAPromptId"),
        null_text().alias("comparsionPromptId"),
    )
    columns = {
        "useCase": F.lit(USE_CASE),
        "userId": F.col("UserID"),
        "uniqueId": F.col("uniqueId"),
        "documentId": F.col("ID"),
        "prompt": prompt,
        "documentName": F.col("DocumentName"),
        "clientName": F.col("CarrierName"),
        "clientID": F.col("clientID"),
        "documentTag": F.col("DocumentType"),
        "documentSubTag": F.col("subTag"),
        "filePath": F.col("DocumentPath"),
        "declarationType": null_text(),
        "processStatus": F.col("Status"),
        "adobeExtractPath": F.col("AdobeExtractPath"),
        "uploadDate": F.col("UploadedAt"),
        "processedDate": F.col("ProcessedAt"),
        "policyStatus": null_text(),
        "retryCount": F.coalesce("RetryCount", F.lit(0)),
        "failure": failure(),
        "formNumber": form_number(),
        "extractedFormNumbers": F.array().cast(f"array<{FORM_NUMBER}>"),
        "isDelete": F.lit(False),
        "isActive": F.lit(True),
        "jsonId": F.col("jsonId"),
        "metaData": F.lit(None).cast(META_DATA),
        "childDocumentIds": F.array().cast(f"array<{CHILD_DOCUMENT}>"),
    }
    return docs.select(*[columns[c].alias(c) for c in TARGET_COLUMNS])


def with_client(docs: DataFrame, clients: DataFrame) -> DataFrame:
    return lookup_first(docs, clients, {"CarrierName": "ClientName"}, {"clientID": "_id"}, ["_id"])


def with_prompt(docs: DataFrame, prompts: DataFrame, policy: Column | None = None) -> DataFrame:
    """Prompt of the carrier and policy name; without a policy only prompts with a null policy match."""
    wanted = docs.withColumn("_policy", null_text() if policy is None else policy)
    on = {"CarrierName": "CarrierName", "_policy": "PolicyName"}
    found = lookup_first(wanted, prompts, on, {"promptId": "PromptID"}, ["PromptID"], null_safe=True)
    return found.drop("_policy")


def named_documents(policies: DataFrame, declarations: DataFrame) -> DataFrame:
    """What policies and declarations say about a document: one row per document id.

    ``base``, ``endo`` and ``dec`` are structs ``(_id, PolicyName, number)`` of the first policy with
    that base document, the first policy with that endorsement and the first declaration that lists
    it. One aggregate over all ids, so that documents are joined to them once.
    """
    number = F.col("DeclarationNumber")
    sources = {
        "base": exploded_ids(policies, "BasePolicyDocumentID").withColumn("number", null_text()),
        "endo": exploded_ids(policies, "EndorsementDocumentID").withColumn("number", null_text()),
        "dec": exploded_ids(declarations, "DeclarationDocumentID").withColumn("number", number),
    }
    said = [df.select("id", F.lit(kind).alias("kind"), "_id", "PolicyName", "number") for kind, df in sources.items()]
    fact = F.struct("_id", "PolicyName", "number")
    firsts = [F.min(F.when(F.col("kind") == kind, fact)).alias(kind) for kind in sources]
    return reduce(DataFrame.unionByName, said).groupBy("id").agg(*firsts)


def migrate_documents(
    docs: DataFrame,
    clients: DataFrame,
    policies: DataFrame,
    declarations: DataFrame,
    prompts: DataFrame,
    use_policy_name: bool = False,
    created: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Target records, payloads and rejects of the policy documents.

    The prompt is looked up before the policy name is known, so only prompts without policy match,
    unless ``use_policy_name`` is set.
    """
    pointed, payloads = split_payload(docs, created)
    checks = {"no id": F.col("ID").isNotNull(), "no document type": F.col("DocumentType").isNotNull()}
    valid, rejects = split_valid(pointed, "Documents", "ID", checks)
    facts = named_documents(policies, declarations)
    kind = document_kind(F.col("DocumentType"))
    name = F.when(kind == "base", F.col("base.PolicyName")).when(kind == "endo", F.col("endo.PolicyName"))
    joined = valid.join(facts, valid["ID"] == facts["id"], "left")
    named = joined.select(
        *[valid[c] for c in valid.columns],
        F.col("dec.number").alias("uniqueId"),
        name.when(kind == "dec", F.col("dec.PolicyName")).alias("subTag"),
    )
    policy = F.col("subTag") if use_policy_name else None
    return to_document(with_prompt(with_client(named, clients), prompts, policy)), payloads, rejects


def migrate_leases(
    leases: DataFrame, clients: DataFrame, prompts: DataFrame, created: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Target records of lease documents: the policy name is given, there is no declaration."""
    pointed, payloads = split_payload(leases, created)
    valid, rejects = split_valid(pointed, "Leases", "ID", {"no id": F.col("ID").isNotNull()})
    named = valid.withColumns({"uniqueId": null_text(), "subTag": F.col("PolicyName")})
    return to_document(with_prompt(with_client(named, clients), prompts)), payloads, rejects


def declaration_meta() -> Column:
    fields = {
        "holderName": F.col("HolderName"),
        "startDate": F.col("StartDate"),
        "endDate": F.col("ExpiryDate"),
        "version": F.col("Version"),
        "cancellationDate": null_text(),
    }
    return F.struct(*[v.cast("string").alias(k) for k, v in fields.items()])


def migrate_declarations(target: DataFrame, declarations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Meta data and number of the declaration on all its documents; a missing id list is rejected."""
    has_ids = {"no declaration documents": F.col("DeclarationDocumentID").isNotNull()}
    valid, rejects = split_valid(declarations, "Declaration", "_id", has_ids)
    source = valid.withColumn("_meta", declaration_meta())
    values = {"metaData": "_meta", "uniqueId": "DeclarationNumber"}
    return update_from(target, source, "documentId", "DeclarationDocumentID", values, ["_id"]), rejects


def policies_with_declaration(policies: DataFrame, declarations: DataFrame) -> DataFrame:
    """Policies whose first declaration (same carrier and policy name) lists documents.

    ``form_ids`` are the base document and the endorsements in order, ``applied`` the endorsements
    of the declaration, ``dec_ids`` its documents.
    """
    packed = declarations.withColumn(
        "_dec", F.struct(F.col("DeclarationDocumentID").alias("dec_ids"), F.col("AppliedEndorsement").alias("applied"))
    )
    on = {"CarrierName": "CarrierName", "PolicyName": "PolicyName"}
    found = lookup_first(policies, packed, on, {"_found": "_dec"}, ["_id"], null_safe=True)
    base = F.array_compact(F.array("BasePolicyDocumentID"))
    endorsements = F.coalesce("EndorsementDocumentID", F.array().cast("array<string>"))
    return found.filter(F.size("_found.dec_ids") > 0).select(
        F.col("_id").alias("policy_id"),
        "_found.dec_ids",
        "_found.applied",
        F.concat(base, endorsements).alias("form_ids"),
    )


def update_child_documents(
    target: DataFrame, policies: DataFrame, declarations: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Children and form numbers on the first record of each declaration document.

    If several policies share a declaration document the last policy wins; the misses are reported
    for every policy. The target is read several
    times and should be a stored table.
    """
    linked = policies_with_declaration(policies, declarations)
    by_id = first_per_key(target, ["documentId"], [*RECORD_ORDER, tie_break(target, ["documentId", *RECORD_ORDER])])
    arrays = {"childDocumentIds": "applied", "extractedFormNumbers": "form_ids"}
    children = {
        "childDocumentIds": F.struct(
            "documentId", F.lit(True).alias("isActive"), "documentTag", "filePath", "jsonId"
        ),
        "extractedFormNumbers": F.when(F.length("formNumber.formNumber") > 0, F.col("formNumber")),
    }
    # the ids of all policies are looked up once, for the winners and for the misses
    hits = stored(array_hits(linked, "policy_id", arrays, by_id, "documentId", children), "hits")
    last = first_per_key(exploded_ids(linked, "dec_ids", "dec_id"), ["dec_id"], [F.desc("policy_id")])
    last = last.select(F.col("dec_id").alias("documentId"), "policy_id")
    winners = hits.join(last.select("policy_id").distinct(), "policy_id", "left_semi")
    updates = last.join(listed_hits(winners, "policy_id", list(arrays)), "policy_id").drop("policy_id")
    updated = apply_updates(target, updates, "documentId", list(arrays), first_only=RECORD_ORDER)

    no_child = (F.col("out") == "childDocumentIds") & F.col("childDocumentIds").isNull()
    no_form = (F.col("out") == "extractedFormNumbers") & F.col("extractedFormNumbers").isNull()
    reason = F.when(no_child, "applied endorsement not found").when(no_form, "form number not found")
    misses = hits.select(F.col("id"), reason.alias("reason")).filter(F.col("reason").isNotNull())
    unlisted = linked.filter(F.col("applied").isNull()).select(
        F.col("policy_id").alias("id"), F.lit("no applied endorsements").alias("reason")
    )
    stage = F.lit("Child_documents").alias("stage")
    return updated, misses.unionByName(unlisted).select(stage, "id", "reason")


def part_records(docs: DataFrame, order: list[str]) -> DataFrame:
    """Documents that are parts (``<base>_<n>``) as ``(base, <order>, part)``."""
    part = F.struct(
        F.col("ID").alias("documentId"),
        F.col("Status").alias("processStatus"),
        F.lit(True).alias("isActive"),
        F.col("DocumentPath").alias("filePath"),
        F.col("DocumentType").alias("documentTag"),
        form_number().alias("formNumber"),
    ).cast(SPLIT_DOCUMENT)
    records = docs.select(base_id(F.col("ID")).alias("base"), *order, part.alias("part"))
    return records.filter(F.col("base").isNotNull())


def merge_parts(docs: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merged records and their parts; parts without base are skipped.

    The parts are a table of their own, ``(documentId, <order>, part)``, so that a base may have any
    number of them; ``order`` are columns that give their order, the id by default.
    """
    order = order or ["ID"]
    parts = part_records(docs, order)
    bases = first_per_key(docs.filter(~F.col("ID").contains("_")), ["ID"], ["DocumentPath", "UploadedAt"])
    first = bases.join(parts.select(F.col("base").alias("ID")).distinct(), "ID", "left_semi")
    headers = first.select(
        null_text().alias("uniqueId"),
        F.col("ID").alias("documentId"),
        F.col("UserID").alias("userId"),
        F.col("CarrierName").alias("clientName"),
        F.lit(MERGED_TAG).alias("documentTag"),
        null_text().alias("documentSubTag"),
        F.col("DocumentName").alias("documentName"),
        F.col("DocumentPath").alias("filePath"),
        F.col("AdobeExtractPath").alias("adobeExtractPath"),
        F.col("UploadedAt").alias("uploadDate"),
        F.col("ProcessedAt").alias("processedDate"),
        F.col("Status").alias("processStatus"),
        F.coalesce("RetryCount", F.lit(0)).alias("retryCount"),
        failure().alias("failure"),
        F.lit(True).alias("isActive"),
        F.create_map().cast("map<string,string>").alias("splitIndices"),
        F.lit(USE_CASE).alias("useCase"),
    )
    found = parts.join(bases.select(F.col("ID").alias("base")), "base", "left_semi")
    return headers, found.withColumnRenamed("base", "documentId")


def nested_parts(headers: DataFrame, parts: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One record per base with its ordered list of parts, which must fit in a row."""
    key = F.struct(*(order or ["ID"]))
    lists = parts.groupBy("documentId").agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), "part"))).alias("l"))
    lists = lists.select("documentId", F.transform("l", lambda e: e["part"]).alias("splitDocumentList"))
    return headers.join(lists, "documentId")


def migrate_all(
    docs: DataFrame,
    leases: DataFrame,
    clients: DataFrame,
    policies: DataFrame,
    declarations: DataFrame,
    prompts: DataFrame,
    created: str | None = None,
) -> dict[str, DataFrame]:
    """All stages in order; leases are added last and so never receive declaration data.

    The records are stored once before the children are resolved against them.
    """
    migrated, payloads, no_type = migrate_documents(docs, clients, policies, declarations, prompts, created=created)
    declared, no_ids = migrate_declarations(migrated, declarations)
    linked, misses = update_child_documents(stored(declared, "declared"), policies, declarations)
    lease_docs, lease_payloads, no_lease = migrate_leases(leases, clients, prompts, created)
    merged, parts = merge_parts(docs)
    rejects = no_type.unionByName(no_ids).unionByName(misses).unionByName(no_lease)
    return {
        "documents": linked.unionByName(lease_docs),
        "payloads": payloads.unionByName(lease_payloads),
        "merged": merged,
        "parts": parts,
        "rejects": rejects,
    }
