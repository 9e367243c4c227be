SELECT b.Service_Date, b.patient_id, n.Note
FROM {fact_billing} b JOIN {dim_clinical_notes} n ON n.Episode_key = b.Episode_key
WHERE b.Service_Date >= :start AND b.Service_Date < :end AND n.Note IS NOT NULL
