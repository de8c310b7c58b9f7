"""Column layouts of the three layers.

Bronze columns bind to CSV fields by position, so their order is part of the contract. The source declares its decimals
without a scale, which means scale 0; `strict_scale=True` reproduces that, the default keeps the fractions.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The provider file layout, one "name type" per line, in file order.
PROVIDER_INFO_LAYOUT = """
CMS_Certification_Number_CCN string
Provider_Name string
Provider_Address string
City_Town string
State string
ZIP_Code int
Telephone_Number string
Provider_SSA_County_Code int
County_Parish string
Ownership_Type string
Number_of_Certified_Beds int
Average_Number_of_Residents_per_Day decimal
Average_Number_of_Residents_per_Day_Footnote string
Provider_Type string
Provider_Resides_in_Hospital string
Legal_Business_Name string
Date_First_Approved_to_Provide_Medicare_and_Medicaid_Services date
Affiliated_Entity_Name string
Affiliated_Entity_ID smallint
Continuing_Care_Retirement_Community string
Special_Focus_Status string
Abuse_Icon string
Most_Recent_Health_Inspection_More_Than_2_Years_Ago string
Provider_Changed_Ownership_in_Last_12_Months string
With_a_Resident_and_Family_Council string
Automatic_Sprinkler_Systems_in_All_Required_Areas string
Overall_Rating decimal
Overall_Rating_Footnote int
Health_Inspection_Rating int
Health_Inspection_Rating_Footnote int
QM_Rating int
QM_Rating_Footnote int
Long_Stay_QM_Rating int
Long_Stay_QM_Rating_Footnote int
Short_Stay_QM_Rating int
Short_Stay_QM_Rating_Footnote int
Staffing_Rating int
Staffing_Rating_Footnote int
Reported_Staffing_Footnote int
Physical_Therapist_Staffing_Footnote int
Reported_Nurse_Aide_Staffing_Hours_per_Resident_per_Day decimal
Reported_LPN_Staffing_Hours_per_Resident_per_Day decimal
Reported_RN_Staffing_Hours_per_Resident_per_Day decimal
Reported_Licensed_Staffing_Hours_per_Resident_per_Day decimal
Reported_Total_Nurse_Staffing_Hours_per_Resident_per_Day decimal
Total_number_of_nurse_staff_hours_per_resident_per_day_on_the_weekend decimal
Registered_Nurse_hours_per_resident_per_day_on_the_weekend decimal
Reported_Physical_Therapist_Staffing_Hours_per_Resident_Per_Day decimal
Total_nursing_staff_turnover decimal
Total_nursing_staff_turnover_footnote int
Registered_Nurse_turnover decimal
Registered_Nurse_turnover_footnote int
Number_of_administrators_who_have_left_the_nursing_home int
Administrator_turnover_footnote int
Nursing_Case_Mix_Index decimal
Nursing_Case_Mix_Index_Ratio decimal
Case_Mix_Nurse_Aide_Staffing_Hours_per_Resident_per_Day decimal
Case_Mix_LPN_Staffing_Hours_per_Resident_per_Day decimal
Case_Mix_RN_Staffing_Hours_per_Resident_per_Day decimal
Case_Mix_Total_Nurse_Staffing_Hours_per_Resident_per_Day decimal
Case_Mix_Weekend_Total_Nurse_Staffing_Hours_per_Resident_per_Day decimal
Adjusted_Nurse_Aide_Staffing_Hours_per_Resident_per_Day decimal
Adjusted_LPN_Staffing_Hours_per_Resident_per_Day decimal
Adjusted_RN_Staffing_Hours_per_Resident_per_Day decimal
Adjusted_Total_Nurse_Staffing_Hours_per_Resident_per_Day decimal
Adjusted_Weekend_Total_Nurse_Staffing_Hours_per_Resident_per_Day decimal
Rating_Cycle_1_Standard_Survey_Health_Date date
Rating_Cycle_1_Total_Number_of_Health_Deficiencies int
Rating_Cycle_1_Number_of_Standard_Health_Deficiencies int
Rating_Cycle_1_Number_of_Complaint_Health_Deficiencies int
Rating_Cycle_1_Health_Deficiency_Score smallint
Rating_Cycle_1_Number_of_Health_Revisits int
Rating_Cycle_1_Health_Revisit_Score int
Rating_Cycle_1_Total_Health_Score int
Rating_Cycle_2_Standard_Health_Survey_Date date
Rating_Cycle_2_Total_Number_of_Health_Deficiencies int
Rating_Cycle_2_Number_of_Standard_Health_Deficiencies int
Rating_Cycle_2_Number_of_Complaint_Health_Deficiencies int
Rating_Cycle_2_Health_Deficiency_Score smallint
Rating_Cycle_2_Number_of_Health_Revisits int
Rating_Cycle_2_Health_Revisit_Score int
Rating_Cycle_2_Total_Health_Score int
Rating_Cycle_3_Standard_Health_Survey_Date date
Rating_Cycle_3_Total_Number_of_Health_Deficiencies int
Rating_Cycle_3_Number_of_Standard_Health_Deficiencies int
Rating_Cycle_3_Number_of_Complaint_Health_Deficiencies int
Rating_Cycle_3_Health_Deficiency_Score int
Rating_Cycle_3_Number_of_Health_Revisits int
Rating_Cycle_3_Health_Revisit_Score int
Rating_Cycle_3_Total_Health_Score int
Total_Weighted_Health_Survey_Score decimal
Number_of_Facility_Reported_Incidents int
Number_of_Substantiated_Complaints int
Number_of_Citations_from_Infection_Control_Inspections int
Number_of_Fines int
Total_Amount_of_Fines_in_Dollars decimal
Number_of_Payment_Denials string
Total_Number_of_Penalties int
Location string
Latitude decimal
Longitude decimal
Geocoding_Footnote int
Processing_Date date
"""

# The daily staffing file opens with these nine text columns; then every nurse class has
# total, employee and contractor hours.
STAFFING_TEXT_COLUMNS = (
    "PROVNUM", "PROVNAME", "CITY", "STATE", "COUNTY_NAME", "COUNTY_FIPS", "CY_Qtr", "WorkDate", "MDScensus",
)
STAFFING_NURSE_CLASSES = ("RNDON", "RNadmin", "RN", "LPNadmin", "LPN", "CNA", "NAtrn", "MedAide")
STAFFING_HOUR_SUFFIXES = ("", "_emp", "_ctr")

COORDINATES = ("Latitude", "Longitude")


def _decimal(name: str, strict_scale: bool) -> T.DecimalType:
    if strict_scale:
        return T.DecimalType(18, 0)
    return T.DecimalType(18, 6 if name in COORDINATES else 2)


def provider_info_schema(strict_scale: bool = False) -> T.StructType:
    plain = {"string": T.StringType(), "int": T.IntegerType(), "smallint": T.ShortType(), "date": T.DateType()}
    schema = T.StructType()
    for line in PROVIDER_INFO_LAYOUT.split("\n"):
        if line:
            name, kind = line.split(" ")
            schema.add(name, _decimal(name, strict_scale) if kind == "decimal" else plain[kind])
    return schema


def daily_nurse_staffing_schema(strict_scale: bool = False) -> T.StructType:
    schema = T.StructType()
    for name in STAFFING_TEXT_COLUMNS:
        schema.add(name, T.StringType())
    for nurse_class in STAFFING_NURSE_CLASSES:
        for suffix in STAFFING_HOUR_SUFFIXES:
            name = f"Hrs_{nurse_class}{suffix}"
            schema.add(name, _decimal(name, strict_scale))
    return schema


MANIFEST = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("load_time", T.TimestampType()),
    ]
)

PROVIDER_DIM = T.StructType(
    [
        T.StructField("ccn", T.StringType()),
        T.StructField("providername", T.StringType()),
        T.StructField("provideraddress", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zipcode", T.IntegerType()),
        T.StructField("numberofbed", T.IntegerType()),
        T.StructField("latitude", T.DecimalType(10, 6)),
        T.StructField("longitude", T.DecimalType(10, 6)),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

STAFFING_TYPE_DIM = T.StructType(
    [
        T.StructField("staffingtypeid", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("staffingtype", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

WORK_DATE_DIM = T.StructType(
    [
        T.StructField("workdateid", T.IntegerType()),
        T.StructField("workdate", T.DateType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("monthname", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def fact_schema(strict_scale: bool = False) -> T.StructType:
    return T.StructType(
        [
            T.StructField("ccn", T.StringType()),
            T.StructField("workdateid", T.StringType()),
            T.StructField("numofpatient", T.IntegerType()),
            T.StructField("staffingtypeid", T.StringType()),
            T.StructField("workhours", _decimal("workhours", strict_scale)),
            T.StructField("updated_at", T.TimestampType()),
        ]
    )


def gold_schema(strict_scale: bool = False) -> T.StructType:
    """Work hours are declared (10,2); the default is wide enough that a busy provider's month cannot overflow."""
    return T.StructType(
        [
            T.StructField("ccn", T.StringType()),
            T.StructField("month", T.IntegerType()),
            T.StructField("monthname", T.StringType()),
            T.StructField("year", T.IntegerType()),
            T.StructField("providername", T.StringType()),
            T.StructField("city", T.StringType()),
            T.StructField("state", T.StringType()),
            T.StructField("longitude", T.DecimalType(10, 6)),
            T.StructField("latitude", T.DecimalType(10, 6)),
            T.StructField("title", T.StringType()),
            T.StructField("staffingtype", T.StringType()),
            T.StructField("totalworkhour", T.DecimalType(10 if strict_scale else 28, 2)),
            T.StructField("bedutilizationrate", T.DecimalType(10, 2)),
            T.StructField("updated_at", T.TimestampType()),
        ]
    )
