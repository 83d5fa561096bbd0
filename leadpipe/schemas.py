"""Declared schemas of the pipeline stages.

Nothing is inferred on read.  The raw feed is positional, so a reader checks
the number of columns and then applies these names.
"""

from pyspark.sql import types as T

RAW_COLUMNS = [
    "url",
    "job_link",
    "title",
    "company_link",
    "account_name",
    "job_location",
    "job_description",
    "job_date",
]

CLEAN_COLUMNS = [
    "JobLink",
    "JobTitle",
    "CompanyLink",
    "AccountName",
    "JobLocation",
    "JobDescription",
    "JobId",
    "PostDate",
]

UPLOAD_COLUMNS = [
    "JobLink",
    "JobTitle",
    "AccountName",
    "JobLocation",
    "JobDescription",
    "JobId",
    "PostDate",
    "titleScore",
    "State",
    "CompanyLink",
]

# Source column -> field of the target object (fixed names of the target layout).
TARGET_FIELDS = {
    "JobId": "JobId__c",
    "AccountName": "Account_Name__c",
    "JobLocation": "Job_Location__c",
    "PostDate": "Post_Date__c",
    "JobTitle": "Job_Title__c",
    "JobLink": "Job_Link__c",
    "CompanyLink": "Company_Link__c",
    "JobDescription": "Job_Description__c",
    "titleScore": "Title_Score__c",
    "State": "State__c",
}
TARGET_TYPE = "Posting__c"

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

TARGET = T.StructType(
    [
        T.StructField(
            field,
            T.DateType()
            if source == "PostDate"
            else T.IntegerType()
            if source == "titleScore"
            else T.StringType(),
        )
        for source, field in TARGET_FIELDS.items()
    ]
    + [T.StructField("type", T.StringType())]
)

# The five scoring sheets; `pos` is the row number in the sheet.
DIMENSIONS = {
    "title_matrix": "pos int, title string, level string, points int",
    "mapping": "pos int, old string, new string",
    "level_mapping": "pos int, actual string, sfdc string",
    "keywords": "pos int, keyword string, points int",
    "no_match_levels": "pos int, job_level string, points int",
}

SEARCH_RESULTS = "query string, rank bigint, url string, score double"
PAGES = "page_id bigint, url string, html string"
