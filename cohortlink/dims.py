"""Literal dimensions.  Small, fixed-size tables: safe to broadcast.

Everything between the "Fixed values" markers must equal the values of the
studied release tool for the outputs to be right; they are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied tool's values)
# ---------------------------------------------------------------------------

# modality, scantype, task, raw-file type, BIDS task suffix, experiment id,
# location column, root sub-folder, session detail
MODALITY_ROWS = [
    ("T1", "MPR", "", "T1", "", "", "proc", "/MRI", "ABCD-MPROC-T1"),
    ("T2", "XetaT2", "", "T2", "", "", "proc", "/MRI", "ABCD-MPROC-T2"),
    ("dMRI", "DTI", "", "DTI", "", "", "proc_dti", "/DTI", "ABCD-MPROC-DTI"),
    ("fMRI_MID_task", "BOLD", "MID", "MID-fMRI", "mid", "648", "proc_bold", "/BOLD", "ABCD-MPROC-MID"),
    ("fMRI_SST_task", "BOLD", "SST", "SST-fMRI", "sst", "650", "proc_bold", "/BOLD", "ABCD-MPROC-SST"),
    ("fMRI_nBack_task", "BOLD", "nBack", "nBack-fMRI", "nback", "651", "proc_bold", "/BOLD", "ABCD-MPROC-NBACK"),
    ("rsfMRI", "BOLD", "", "rsfMRI", "rest", "649", "proc_bold", "/BOLD", "ABCD-MPROC-REST"),
]

# site -> output-folder alias; other sites keep their name
SITE_ALIAS = {"ucsd": "daic", "umb": "oahu", "wustl": "washu"}

# catalogue series types accepted per modality (T1/T2 also take the NORM type)
TYPE_FAMILY = {"T1": ["T1", "T1_NORM"], "T2": ["T2", "T2_NORM"]}

# scan-group names of the container metadata that carry series attributes
ACCEPTED_SCAN_TYPES = ["MPR", "XetaT2", "BOLD", "DTI"]

# attributes copied from scan groups onto series ("TI" only for T1)
SCAN_ATTRS = ["ndiffdirs", "nreps", "TR", "TE", "FlipAngle"]

# quality thresholds
DTI_NDIFFDIRS_MIN = 50
BOLD_NREPS_MIN = 100

IMAGE_HISTORY_STRUCT = ("gradient unwarp, B1 inhomogeneity correction, resampled to 1mm^3 isotropic "
                        "in LIA rigid body registration to non-MNI atlas")
IMAGE_HISTORY_BOLD = ("motion correction, B0 inhomogeneity correction, gradient unwarp, between scan "
                      "motion correction, and resampling to 2.4mm^3 (requires rigid registration to T1 "
                      "- see included json for matrix values)")
IMAGE_HISTORY_DTI = ("eddy-current correction, motion correction, B0 inhomogeneity correction, gradient "
                     "unwarp, replacement of bad slice-frames, between scan motion correction, rigid body "
                     "registration to atlas and resampling to 1.7mm^3 LPI (requires rigid registration to "
                     "T1 - see included json for matrix values)")

# scantype, BIDS folder, BIDS suffix, scan_type text, image_history, structural image name prefix
SCANTYPE_ROWS = [
    ("MPR", "anat", "_T1w", "MR structural (T1)", IMAGE_HISTORY_STRUCT, "MPR_res.mgz"),
    ("XetaT2", "anat", "_T2w", "MR structural (T2)", IMAGE_HISTORY_STRUCT, "T2w_res.mgz"),
    ("BOLD", "func", "_bold", "fMRI", IMAGE_HISTORY_BOLD, None),
    ("DTI", "dwi", "_dwi", "multishell DTI", IMAGE_HISTORY_DTI, None),
]

# processed-file name parts
BOLD_IMAGE_INFIX = "_for_corr_resBOLD.mgz"
BOLD_MOTION_INFIX = "_for_corr_resBOLD_motion.1D"
BOLD_REG_SUFFIXES = ["_for_corr_resBOLD_regT1.mat", "_for_f0_corr_resBOLD_regT1.mat"]  # first, else second
DTI_EXPORT_DIR = "exportDTIforFSL"
DTI_IMAGE_INFIX = ".nii.gz"
DTI_BVALS_INFIX = "bvals"
DTI_BVECS_INFIX = "bvecs"
DTI_REG_SUFFIX = "_corr_regT1_regT1.mat"
DTI_REG_EXCLUDE = "rev"
RAW_STRUCT_MARK = "NORM"
CONTAINER_MARK = "PROC"

PROJECT_ID = "DAL_ABCD"            # location row of the processed data
SUBJECT_PREFIX = "NDAR"
NAME_TYPE_MARK = "ABCD-"
NAME_TYPE_NEW = "ABCD-MPROC-"
RELEASE_BUCKET = "s3://abcd-mproc-patch/"
RAW_BUCKET = "s3://nda-abcd/"
DESCRIPTION_MEMBER = "dataset_description.json"

# submission literals
INPUTS_TEXT = "ABCD Fast-Track image data release for baseline assessments"
PIPELINE = "MMPS version 248"
PIPELINE_SCRIPT = "MMIL_Preproc"
PIPELINE_TOOLS = "MMPS"
PIPELINE_TYPE = "MMPS"
PIPELINE_VERSION = "248"
QC_OUTCOME = "pass"
SCHEMA_NAME = "abcd_upload_107927"
SHORT_NAME = "fmriresults01"

SUBMISSION_COLUMNS = [
    "subjectkey", "src_subject_id", "origin_dataset_id", "interview_date", "interview_age", "gender",
    "experiment_id", "inputs", "img03_id", "file_source", "job_name", "proc_types", "metric_files",
    "pipeline", "pipeline_script", "pipeline_tools", "pipeline_type", "pipeline_version",
    "qc_fail_quest_reason", "qc_outcome", "derived_files", "scan_type", "img03_id2", "file_source2",
    "session_det", "image_history",
]

# outcome columns of the ledger rows
LEDGER_OUTCOME_COLUMNS = ["miNDA_ok", "miNDA_msg", "s3_ok", "s3_msg"]

# delivery messages
DRY_SUBMIT_MSG = "Here I would upload record to miNDA"
DRY_UPLOAD_MSG = "Here I would upload data set to AWS-s3"
UPLOAD_SKIPPED_MSG = "AWS-s3 not attempted because miNDA upload failed"
REG_NO_SUBJECT_MSG = "Subject not found in NDA database package: %s. "
REG_NO_FILE_MSG = "FsTk file name not found in NDA database package. "
REG_MANY_MSG = "More than one FsTk file name match found in NDA database package; taking last entry. "

# motion table: 9 blank-separated numbers per line, the last two dropped
MOTION_COLUMNS = ["t_indx", "rot_z", "rot_x", "rot_y", "trans_z", "trans_x", "trans_y"]
MOTION_WIDTH = 9

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

MODALITY_COLUMNS = ["modality", "scantype", "task", "raw_type", "bids_task", "experiment_id",
                    "root_column", "root_sub", "session_det"]
SCANTYPE_COLUMNS = ["scantype", "bids_type", "bids_suffix", "scan_type", "image_history", "struct_prefix"]


def modality_dim(spark: SparkSession) -> DataFrame:
    """Seven-row modality table (fixed size: broadcast freely)."""
    return spark.createDataFrame(MODALITY_ROWS, MODALITY_COLUMNS)


def scantype_dim(spark: SparkSession) -> DataFrame:
    """Four-row scan-type table (fixed size: broadcast freely)."""
    return spark.createDataFrame(
        SCANTYPE_ROWS,
        "scantype string, bids_type string, bids_suffix string, scan_type string, "
        "image_history string, struct_prefix string")


def family_dim(spark: SparkSession) -> DataFrame:
    """(modality, series_type) pairs: the catalogue types each modality takes."""
    rows = []
    for m, *_ in MODALITY_ROWS:
        for t in TYPE_FAMILY.get(m, [m]):
            rows.append((m, t))
    return spark.createDataFrame(rows, "modality string, series_type string")


def site_alias_map():
    """Alias map as a literal map Column."""
    items = []
    for k, v in SITE_ALIAS.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
