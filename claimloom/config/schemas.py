"""Schemas at the boundaries, as DDL text."""

from __future__ import annotations

LOAD_COUNT = "TotalCount int, TableName string"
MARK = "source string, mark timestamp, run_at timestamp"
LOAD_STATUS = "source string, ok boolean, rows bigint, error string"

DEMAND = (
    "average_temprature double, rainfall double, weekend bigint, holiday int, "
    "price_per_kg double, promo int, previous_days_demand double"
)

TEXT_CLAIM = "Status string, Levels string, Rooms string, Materials string, Engagement string, source string"
CODED_CLAIM = (
    "PerilTypeID string, Status string, Levels string, `Rooms affected` string, materials string, Engagement string"
)

FORECAST_FILE = "forecast_date date, Amount double, Source string, Region string, Load_date date"
FORECAST = "region string, ds date, yhat double, yhat_lower double, yhat_upper double"

DOCUMENT = (
    "ID string, DocumentType string, CarrierName string, UserID string, DocumentName string, DocumentPath string, "
    "Status string, AdobeExtractPath string, FailureReason string, FormNumber string, NormalizedFormNumber string, "
    "UploadedAt timestamp, ProcessedAt timestamp, RetryCount int, FailureStatusCode array<string>, JsonData string, "
    "PolicyName string"
)
DECLARATION = (
    "_id string, DeclarationNumber string, HolderName string, CarrierName string, PolicyName string, ProcessedFormat string, "
    "StartDate string, ExpiryDate string, Version string, DeclarationDocumentID array<string>, "
    "AppliedEndorsement array<string>"
)
POLICY = (
    "_id string, CarrierName string, PolicyName string, BasePolicyDocumentID string, EndorsementDocumentID array<string>"
)
CLIENT = "_id string, ClientName string"
PROMPT = "CarrierName string, PolicyName string, PromptID string"

FORM_NUMBER = "struct<formNumber: string, normalizedFormNumber: string>"
CHILD_DOCUMENT = "struct<documentId: string, isActive: boolean, documentTag: string, filePath: string, jsonId: string>"
META_DATA = (
    "struct<holderName: string, startDate: string, endDate: string, version: string, cancellationDate: string>"
)
SPLIT_DOCUMENT = (
    "struct<documentId: string, processStatus: string, isActive: boolean, filePath: string, documentTag: string, "
    f"formNumber: {FORM_NUMBER}>"
)
