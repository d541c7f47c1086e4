"""Declared schemas of the long tables and of the saved replies, as DDL."""

MANIFEST = ("file_id string, file_name string, patient_id string")
RNA_LONG = (
    "patient_id string, gene_id string, gene_name string, gene_type string, "
    "fpkm_unstranded double, tpm_unstranded double, fpkm_uq_unstranded double"
)
METHYLATION_LONG = ("patient_id string, probe_id string, beta_value double")
SEGMENT_LONG = (
    "patient_id string, chromosome string, start bigint, `end` bigint, copy_number double"
)
PROTEIN_LONG = ("patient_id string, peptide_target string, protein_expression double")
MIRNA_LONG = ("patient_id string, mirna_id string, reads_per_million_mirna_mapped double")
MUTATION_LONG = ("patient_id string, hugo_symbol string, mutated double")
LEDGER = ("patient_id string, file_id string, error string")
MEASUREMENT = (
    "cohort string, modality string, patient_id string, feature_id string, value double"
)

#: Repository reply: hits with nested cases.
MANIFEST_JSON = (
    "data struct<hits: array<struct<file_id: string, file_name: string, "
    "cases: array<struct<submitter_id: string>>>>>"
)
LABEL_JSON = ("patientId string, value string")
