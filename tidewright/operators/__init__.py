"""Plan builders from DataFrame to DataFrame; none of them runs a job."""
