"""Matching messages against a labelled catalogue of message templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from riftlog.config import WILDCARD

# The labelled templates.
CATALOGUE = (
    ("E1", "[instance: <*>] Attempting claim: memory <*> MB, disk <*> GB, vcpus <*> CPU"),
    ("E2", "[instance: <*>] Claim successful"),
    ("E3", "[instance: <*>] Creating image"),
    ("E4", "[instance: <*>] Deleting instance files <*>"),
    ("E5", "[instance: <*>] Deletion of <*> complete"),
    ("E6", "[instance: <*>] disk limit not specified, defaulting to unlimited"),
    ("E7", "[instance: <*>] During sync_power_state the instance has a pending task (spawning). Skip."),
    ("E8", "[instance: <*>] Instance destroyed successfully."),
    ("E9", "[instance: <*>] Instance spawned successfully."),
    ("E10", "[instance: <*>] memory limit: <*>.<*> MB, free: <*>.<*> MB"),
    ("E11", "[instance: <*>] Terminating instance"),
    ("E12", "[instance: <*>] Took <*>.<*> seconds to build instance."),
    ("E13", "[instance: <*>] Took <*>.<*> seconds to deallocate network for instance."),
    ("E14", "[instance: <*>] Took <*>.<*> seconds to destroy the instance on the hypervisor."),
    ("E15", "[instance: <*>] Took <*>.<*> seconds to spawn the instance on the hypervisor."),
    ("E16", "[instance: <*>] Total disk: <*> GB, used: <*>.<*> GB"),
    ("E17", "[instance: <*>] Total memory: <*> MB, used: <*>.<*> MB"),
    ("E18", "[instance: <*>] Total vcpu: <*> VCPU, used: <*>.<*> VCPU"),
    ("E19", "[instance: <*>] vcpu limit not specified, defaulting to unlimited"),
    ("E20", "[instance: <*>] VM Paused (Lifecycle Event)"),
    ("E21", "[instance: <*>] VM Resumed (Lifecycle Event)"),
    ("E22", "[instance: <*>] VM Started (Lifecycle Event)"),
    ("E23", "[instance: <*>] VM Stopped (Lifecycle Event)"),
    ("E24", '<*> "DELETE <*>" status: <*> len: <*> time: <*>.<*>'),
    ("E25", '<*> "GET <*>" status: <*> len: <*> time: <*>.<*>'),
    ("E26", '<*> "POST <*>" status: <*> len: <*> time: <*>.<*>'),
    ("E27", "Active base files: <*>"),
    ("E28", "Auditing locally available compute resources for node <*>"),
    ("E29", "Base or swap file too young to remove: <*>"),
    ("E30", "Compute_service record updated for <*>"),
    ("E31", "Creating event network-vif-plugged:<*>-<*>-<*>-<*>-<*> for instance <*>"),
    ("E32", "Final resource view: name=<*> phys_ram=<*> used_ram=<*> phys_disk=<*> used_disk=<*> total_vcpus=<*> used_vcpus=<*> pci_stats=[]"),
    ("E33", "HTTP exception thrown: No instances found for any event"),
    ("E34", "image <*> at (<*>): checking"),
    ("E35", "image <*> at (<*>): in use: on this node <*> local, <*> on other nodes sharing this instance storage"),
    ("E36", "Removable base files: <*>"),
    ("E37", "Removing base or swap file: <*>"),
    ("E38", "Running instance usage audit for host <*> from <*>-<*>-<*> <*>:<*>:<*> to <*>-<*>-<*> <*>:<*>:<*>. <*> instances."),
    ("E39", "Successfully synced instances from host '<*>'."),
    ("E40", "The instance sync for host '<*>' did not match. Re-created its InstanceList."),
    ("E41", "Total usable vcpus: <*>, total allocated vcpus: <*>"),
    ("E42", "Unknown base file: <*>"),
    ("E43", "While synchronizing instance power states, found <*> instances in the database and <*> instances on the hypervisor."),
)
# End of fixed values.


def catalogue_regex(template: str) -> str:
    """Anchored pattern of a template; a wildcard stands for any text."""
    return "^" + "(.*?)".join(re.escape(p) for p in template.split(WILDCARD)) + "$"


def specificity(template: str) -> int:
    """Letters a template fixes; the higher, the more specific."""
    return len(template.replace(WILDCARD, ""))


def event_id(message: Column, catalogue=CATALOGUE) -> Column:
    """The id of the most specific template that fits, else null. A chain of
    conditions in the row itself: the catalogue is a constant, so nothing is
    joined. A cheap test of the fixed head spares most patterns."""
    chain = None
    for name, template in sorted(catalogue, key=lambda t: -specificity(t[1])):
        head = template.split(WILDCARD)[0]
        fits = message.rlike("(?d)" + catalogue_regex(template))
        if head:
            fits = message.startswith(head) & fits
        chain = F.when(fits, F.lit(name)) if chain is None else chain.when(fits, F.lit(name))
    return chain


def match_catalogue(rows: DataFrame, message: str = "message", catalogue=CATALOGUE) -> DataFrame:
    return rows.withColumn("event_id", event_id(F.col(message), catalogue))
