"""sparkdesk: table export, order intake, caption building, job folding and token checks on Spark."""
