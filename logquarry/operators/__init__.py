"""DataFrame to DataFrame operators; none of them runs a job."""
