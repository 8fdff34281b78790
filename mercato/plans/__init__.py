"""Pipeline stages: silver cleaning, gold reports, quality guards, audit, job."""
