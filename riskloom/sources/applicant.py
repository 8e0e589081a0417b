"""The applicant record: 121 nullable fields, one declared schema for CSV, JSON and streams."""

from pyspark.sql import types as T

LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()

# Field names and types of the record, in their natural order.
APPLICANT_SCHEMA = T.StructType(
    [
        T.StructField("SK_ID_CURR", LONG),
        T.StructField("NAME_CONTRACT_TYPE", TEXT),
        T.StructField("CODE_GENDER", TEXT),
        T.StructField("FLAG_OWN_CAR", TEXT),
        T.StructField("FLAG_OWN_REALTY", TEXT),
        T.StructField("CNT_CHILDREN", LONG),
        T.StructField("AMT_INCOME_TOTAL", DOUBLE),
        T.StructField("AMT_CREDIT", DOUBLE),
        T.StructField("AMT_ANNUITY", DOUBLE),
        T.StructField("AMT_GOODS_PRICE", DOUBLE),
        T.StructField("NAME_TYPE_SUITE", TEXT),
        T.StructField("NAME_INCOME_TYPE", TEXT),
        T.StructField("NAME_EDUCATION_TYPE", TEXT),
        T.StructField("NAME_FAMILY_STATUS", TEXT),
        T.StructField("NAME_HOUSING_TYPE", TEXT),
        T.StructField("REGION_POPULATION_RELATIVE", DOUBLE),
        T.StructField("DAYS_BIRTH", LONG),
        T.StructField("DAYS_EMPLOYED", DOUBLE),
        T.StructField("DAYS_REGISTRATION", DOUBLE),
        T.StructField("DAYS_ID_PUBLISH", LONG),
        T.StructField("OWN_CAR_AGE", LONG),
        T.StructField("FLAG_MOBIL", LONG),
        T.StructField("FLAG_EMP_PHONE", LONG),
        T.StructField("FLAG_WORK_PHONE", LONG),
        T.StructField("FLAG_CONT_MOBILE", LONG),
        T.StructField("FLAG_PHONE", LONG),
        T.StructField("FLAG_EMAIL", LONG),
        T.StructField("OCCUPATION_TYPE", TEXT),
        T.StructField("CNT_FAM_MEMBERS", DOUBLE),
        T.StructField("REGION_RATING_CLIENT", LONG),
        T.StructField("REGION_RATING_CLIENT_W_CITY", LONG),
        T.StructField("WEEKDAY_APPR_PROCESS_START", TEXT),
        T.StructField("HOUR_APPR_PROCESS_START", LONG),
        T.StructField("REG_REGION_NOT_LIVE_REGION", LONG),
        T.StructField("REG_REGION_NOT_WORK_REGION", LONG),
        T.StructField("LIVE_REGION_NOT_WORK_REGION", LONG),
        T.StructField("REG_CITY_NOT_LIVE_CITY", LONG),
        T.StructField("REG_CITY_NOT_WORK_CITY", LONG),
        T.StructField("LIVE_CITY_NOT_WORK_CITY", LONG),
        T.StructField("ORGANIZATION_TYPE", TEXT),
        T.StructField("EXT_SOURCE_1", DOUBLE),
        T.StructField("EXT_SOURCE_2", DOUBLE),
        T.StructField("EXT_SOURCE_3", DOUBLE),
        T.StructField("APARTMENTS_AVG", DOUBLE),
        T.StructField("BASEMENTAREA_AVG", DOUBLE),
        T.StructField("YEARS_BEGINEXPLUATATION_AVG", DOUBLE),
        T.StructField("YEARS_BUILD_AVG", DOUBLE),
        T.StructField("COMMONAREA_AVG", DOUBLE),
        T.StructField("ELEVATORS_AVG", DOUBLE),
        T.StructField("ENTRANCES_AVG", DOUBLE),
        T.StructField("FLOORSMAX_AVG", DOUBLE),
        T.StructField("FLOORSMIN_AVG", DOUBLE),
        T.StructField("LANDAREA_AVG", DOUBLE),
        T.StructField("LIVINGAPARTMENTS_AVG", DOUBLE),
        T.StructField("LIVINGAREA_AVG", DOUBLE),
        T.StructField("NONLIVINGAPARTMENTS_AVG", DOUBLE),
        T.StructField("NONLIVINGAREA_AVG", DOUBLE),
        T.StructField("APARTMENTS_MODE", DOUBLE),
        T.StructField("BASEMENTAREA_MODE", DOUBLE),
        T.StructField("YEARS_BEGINEXPLUATATION_MODE", DOUBLE),
        T.StructField("YEARS_BUILD_MODE", DOUBLE),
        T.StructField("COMMONAREA_MODE", DOUBLE),
        T.StructField("ELEVATORS_MODE", DOUBLE),
        T.StructField("ENTRANCES_MODE", DOUBLE),
        T.StructField("FLOORSMAX_MODE", DOUBLE),
        T.StructField("FLOORSMIN_MODE", DOUBLE),
        T.StructField("LANDAREA_MODE", DOUBLE),
        T.StructField("LIVINGAPARTMENTS_MODE", DOUBLE),
        T.StructField("LIVINGAREA_MODE", DOUBLE),
        T.StructField("NONLIVINGAPARTMENTS_MODE", DOUBLE),
        T.StructField("NONLIVINGAREA_MODE", DOUBLE),
        T.StructField("APARTMENTS_MEDI", DOUBLE),
        T.StructField("BASEMENTAREA_MEDI", DOUBLE),
        T.StructField("YEARS_BEGINEXPLUATATION_MEDI", DOUBLE),
        T.StructField("YEARS_BUILD_MEDI", DOUBLE),
        T.StructField("COMMONAREA_MEDI", DOUBLE),
        T.StructField("ELEVATORS_MEDI", DOUBLE),
        T.StructField("ENTRANCES_MEDI", DOUBLE),
        T.StructField("FLOORSMAX_MEDI", DOUBLE),
        T.StructField("FLOORSMIN_MEDI", DOUBLE),
        T.StructField("LANDAREA_MEDI", DOUBLE),
        T.StructField("LIVINGAPARTMENTS_MEDI", DOUBLE),
        T.StructField("LIVINGAREA_MEDI", DOUBLE),
        T.StructField("NONLIVINGAPARTMENTS_MEDI", DOUBLE),
        T.StructField("NONLIVINGAREA_MEDI", DOUBLE),
        T.StructField("FONDKAPREMONT_MODE", TEXT),
        T.StructField("HOUSETYPE_MODE", DOUBLE),
        T.StructField("TOTALAREA_MODE", TEXT),
        T.StructField("WALLSMATERIAL_MODE", TEXT),
        T.StructField("EMERGENCYSTATE_MODE", DOUBLE),
        T.StructField("OBS_30_CNT_SOCIAL_CIRCLE", DOUBLE),
        T.StructField("DEF_30_CNT_SOCIAL_CIRCLE", DOUBLE),
        T.StructField("OBS_60_CNT_SOCIAL_CIRCLE", DOUBLE),
        T.StructField("DEF_60_CNT_SOCIAL_CIRCLE", DOUBLE),
        T.StructField("DAYS_LAST_PHONE_CHANGE", DOUBLE),
        T.StructField("FLAG_DOCUMENT_2", LONG),
        T.StructField("FLAG_DOCUMENT_3", LONG),
        T.StructField("FLAG_DOCUMENT_4", LONG),
        T.StructField("FLAG_DOCUMENT_5", LONG),
        T.StructField("FLAG_DOCUMENT_6", LONG),
        T.StructField("FLAG_DOCUMENT_7", LONG),
        T.StructField("FLAG_DOCUMENT_8", LONG),
        T.StructField("FLAG_DOCUMENT_9", LONG),
        T.StructField("FLAG_DOCUMENT_10", LONG),
        T.StructField("FLAG_DOCUMENT_11", LONG),
        T.StructField("FLAG_DOCUMENT_12", LONG),
        T.StructField("FLAG_DOCUMENT_13", LONG),
        T.StructField("FLAG_DOCUMENT_14", LONG),
        T.StructField("FLAG_DOCUMENT_15", LONG),
        T.StructField("FLAG_DOCUMENT_16", LONG),
        T.StructField("FLAG_DOCUMENT_17", LONG),
        T.StructField("FLAG_DOCUMENT_18", LONG),
        T.StructField("FLAG_DOCUMENT_19", LONG),
        T.StructField("FLAG_DOCUMENT_20", LONG),
        T.StructField("FLAG_DOCUMENT_21", LONG),
        T.StructField("AMT_REQ_CREDIT_BUREAU_HOUR", DOUBLE),
        T.StructField("AMT_REQ_CREDIT_BUREAU_DAY", DOUBLE),
        T.StructField("AMT_REQ_CREDIT_BUREAU_WEEK", DOUBLE),
        T.StructField("AMT_REQ_CREDIT_BUREAU_MON", DOUBLE),
        T.StructField("AMT_REQ_CREDIT_BUREAU_QRT", DOUBLE),
        T.StructField("AMT_REQ_CREDIT_BUREAU_YEAR", DOUBLE),
    ]
)
