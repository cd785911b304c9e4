"""logbeam.plans."""
