"""Column types of the four input tables. Account and customer numbers are text (``ACCT28942``); dates are day serials."""

from __future__ import annotations

ACCOUNTS = {
    "ACCT_NBR": "string",
    "CUST_ID": "string",
    "CANCEL_NO_CONTACT": "int",
    "IS_DIGITAL": "int",
    "ACCT_OPEN_DT": "int",
    "AUM_AMT": "double",
}
IDENTITY = {"CUST_ID": "string", "DATE_OF_BIRTH": "int", "YEARLYINCOMELEVEL": "int", "CNTY_CD": "int"}
TRANSACTIONS = {
    "ACCT_NBR": "string",
    "CUST_ID": "string",
    "TX_DATE": "int",
    "TX_TIME": "int",
    "DRCR": "int",
    "TX_AMT": "double",
    "PB_BAL": "double",
    "OWN_TRANS_ACCT": "string",
    "OWN_TRANS_ID": "string",
    "CHANNEL_CODE": "int",
    "TRN_CODE": "int",
    "BRANCH_NO": "string",
    "EMP_NO": "string",
    "mb_check": "int",
    "eb_check": "int",
    "SAME_NUMBER_IP": "int",
    "SAME_NUMBER_UUID": "int",
    "DAY_OF_WEEK": "string",
}
NOTICES = {"CUST_ID": "string", "ACCT_NBR": "string", "DATA_DT": "int"}
ANSWER = {"ACCT_NBR": "string", "Y": "string"}
